"""The property graph as DataFrames.

``nodes`` and ``edges`` hold one row per record. A record's own properties sit
in the row as a map of tagged string arrays, so their size is bounded by the
source record and every per-record rule is a narrow expression.

Properties that are *merged from many records* have no such bound: a concept
may be fed by a third of all rows. They are never collected into one array but
kept as one row per value in ``node_values`` and ``edge_values``.

Edges carry the labels of both ends. Labels never change after a node is made,
so this copy is safe, and it turns every label test on an edge (deletion,
schema edges, label patterns) into a filter instead of two joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAPPED_TO = "MAPPED_TO"

PROP = "struct<dtype:string,is_list:boolean,vals:array<string>>"
PROPS = f"map<string,{PROP}>"
NODE = f"id bigint, labels array<string>, props {PROPS}"
EDGE = f"src bigint, src_labels array<string>, dst bigint, dst_labels array<string>, rel string, props {PROPS}"
NODE_VALUE = "id bigint, labels array<string>, key string, dtype string, pos bigint, val string"
EDGE_VALUE = (
    "src bigint, src_labels array<string>, dst bigint, dst_labels array<string>, "
    "rel string, key string, dtype string, is_list boolean, val string"
)

SCHEMAS = {
    "nodes": NODE,
    "edges": EDGE,
    "node_values": NODE_VALUE,
    "edge_values": EDGE_VALUE,
}
COLUMNS = {name: [part.split()[0] for part in _fields.split(", ")] for name, _fields in SCHEMAS.items()}


@dataclass(frozen=True)
class Graph:
    """The four tables; the last two are None while they have no rows."""

    nodes: DataFrame
    edges: DataFrame
    node_values: DataFrame | None = None
    edge_values: DataFrame | None = None

    @classmethod
    def of(cls, nodes: DataFrame, edges: DataFrame | None = None) -> "Graph":
        return cls(nodes=nodes, edges=empty(nodes.sparkSession, "edges") if edges is None else edges)

    def table(self, name: str) -> DataFrame:
        """A table by name, empty rather than None."""
        found = getattr(self, name)
        return empty(self.nodes.sparkSession, name) if found is None else found.select(*COLUMNS[name])

    def with_(self, **tables: DataFrame | None) -> "Graph":
        return replace(
            self,
            **{name: None if table is None else table.select(*COLUMNS[name]) for name, table in tables.items()},
        )


def empty(spark: SparkSession, table: str) -> DataFrame:
    columns = [part.split(" ", 1) for part in SCHEMAS[table].split(", ")]
    casts = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in columns)
    return spark.sql(f"SELECT {casts} WHERE false")


def plus(*parts: DataFrame | None) -> DataFrame | None:
    """Union of the parts that are there."""
    there = [part for part in parts if part is not None]
    return reduce(DataFrame.unionByName, there) if there else None


def maybe(table: DataFrame | None, rule: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Apply a rule to a table that may be None."""
    return None if table is None else rule(table)


# --- building property maps -------------------------------------------------


def scalar(value: Column, dtype: str = "String") -> Column:
    return F.struct(
        F.lit(dtype).alias("dtype"), F.lit(False).alias("is_list"), F.array(value.cast("string")).alias("vals")
    )


def listing(values: Column, dtype: str = "String") -> Column:
    return F.struct(
        F.lit(dtype).alias("dtype"), F.lit(True).alias("is_list"), values.cast("array<string>").alias("vals")
    )


def props(**named: Column) -> Column:
    """Property map from columns that are never null."""
    if not named:
        return no_props()
    return F.create_map(*[part for key, value in named.items() for part in (F.lit(key), value)])


def no_props() -> Column:
    return F.expr(f"cast(map() as {PROPS})")


def put(old: Column, **named: Column) -> Column:
    """Set properties, replacing those already there; the map is filtered only when it has one of them."""
    names = list(named)
    present = reduce(Column.__or__, [F.map_contains_key(old, name) for name in names])
    others = F.when(present, F.map_filter(old, lambda k, _: ~k.isin(*names))).otherwise(old)
    return F.map_concat(others, props(**named))


def head_label(labels: Column) -> Column:
    return F.get(labels, F.lit(0))


def vals(properties: Column, key: str) -> Column:
    """Values of one property; null when the record does not have it."""
    return F.try_element_at(properties, F.lit(key))["vals"]


def graph_type(dtype: Column, is_list: Column) -> Column:
    return F.when(is_list, F.concat(dtype, F.lit("Array"))).otherwise(dtype)


# --- exploded views ---------------------------------------------------------


def property_rows(nodes: DataFrame) -> DataFrame:
    """One row per record property: id, labels, key, dtype, is_list, vals."""
    return each_property(nodes, "id", "labels").select("id", "labels", "key", "p.dtype", "p.is_list", "p.vals")


def each_property(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per entry of ``props`` as ``key`` and ``p``.

    A plain ``explode`` gets a filter on the map's size inferred below it, which
    works out a map that is still an expression a second time.
    """
    return rows.select(*columns, F.explode_outer("props").alias("key", "p")).filter("key IS NOT NULL")


def value_rows(graph: Graph) -> DataFrame:
    """One row per property value, record properties and merged ones alike."""
    own = (
        property_rows(graph.nodes)
        .select("id", "labels", "key", "dtype", "is_list", F.posexplode("vals").alias("pos", "val"))
        .filter(F.col("val").isNotNull())
        .select("id", "labels", "key", "dtype", "is_list", F.col("pos").cast("bigint").alias("pos"), "val")
    )
    merged = maybe(
        graph.node_values,
        lambda t: t.select("id", "labels", "key", "dtype", F.lit(True).alias("is_list"), "pos", "val"),
    )
    return plus(own, merged)


def edge_property_rows(edges: DataFrame) -> DataFrame:
    ends = ["src", "src_labels", "dst", "dst_labels", "rel"]
    return each_property(edges, *ends).select(*ends, "key", "p.dtype", "p.is_list", "p.vals")
