"""Look-ups over nodes, and the resume rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.model import Graph, property_rows, scalar, vals


def nodes_with_label(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.filter(F.array_contains("labels", label))


def node_labels(nodes: DataFrame) -> DataFrame:
    """Distinct labels in use."""
    return nodes.select(F.explode("labels").alias("label")).distinct()


def properties_of(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """Records of the given ids (column ``id``): id, head label, props."""
    return nodes.join(ids.select("id").distinct(), "id", "left_semi").select(
        "id", F.get("labels", F.lit(0)).alias("label"), "props"
    )


def find(nodes: DataFrame, label: str, **conditions) -> DataFrame:
    """Nodes of a label whose scalar properties equal all given values; no condition means all."""
    found = nodes_with_label(nodes, label)
    for key, value in conditions.items():
        text = str(value).lower() if isinstance(value, bool) else str(value)
        prop = F.try_element_at("props", F.lit(key))
        found = found.filter(~prop["is_list"] & (F.get(prop["vals"], F.lit(0)) == text))
    return found


def samples(nodes: DataFrame, label: str, limit: int = 10) -> DataFrame:
    """First records of a label by id."""
    return nodes_with_label(nodes, label).orderBy("id").limit(limit)


def property_examples(nodes: DataFrame, label: str, key: str, limit: int = 5) -> DataFrame:
    """First distinct values of one property, in order of the value."""
    if "`" in key:
        raise ValueError("property name contains a backtick")
    prop = F.try_element_at("props", F.lit(key))
    value = F.when(prop["is_list"], F.to_json(prop["vals"])).otherwise(F.get(prop["vals"], F.lit(0)))
    return (
        nodes_with_label(nodes, label).select(value.alias("val")).filter("val IS NOT NULL").distinct()
        .orderBy("val").limit(limit)
    )


def property_samples(nodes: DataFrame, limit: int = 5) -> DataFrame:
    """First non-null values by node id for every (label, key) in one pass.

    ``row_number() <= limit`` lets Spark cut each group before the shuffle, so a
    label that holds most rows sends only ``limit`` rows per task.
    """
    order = Window.partitionBy("label", "key").orderBy("id")
    return (
        property_rows(nodes)
        .filter(F.size("vals") > 0)
        .select(F.explode("labels").alias("label"), "key", "id", "dtype", "is_list", "vals")
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= limit)
    )


def save_record(nodes: DataFrame, label: str, record_id: Column, **values: Column) -> DataFrame:
    """Node rows from the columns of a table; null columns give no property. Append them to a store."""
    entries = [
        F.when(value.isNotNull(), F.struct(F.lit(key).alias("key"), scalar(value).alias("value")))
        for key, value in values.items()
    ]
    present = F.map_from_entries(F.array_compact(F.array(*entries)))
    return nodes.select(
        record_id.cast("bigint").alias("id"), F.array(F.lit(label)).alias("labels"), present.alias("props")
    )


def pending(available: DataFrame, *done: DataFrame) -> DataFrame:
    """Rows of ``available`` whose key (its columns) is in none of the done tables."""
    for table in done:
        available = available.join(table.select(*available.columns), available.columns, "left_anti")
    return available


def values_of(graph: Graph, label: str, key: str) -> DataFrame:
    """Flattened values of one property: id, val."""
    return nodes_with_label(graph.nodes, label).select("id", F.explode(vals(F.col("props"), key)).alias("val"))
