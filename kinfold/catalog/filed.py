"""Inputs and outputs in files: each query writes a file from a supplied table, reads it back and reports what it read."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.catalog import filtering, sql
from kinfold.functions.names import column_names
from kinfold.model import Graph, empty, property_rows
from kinfold.operators import accession, policy, routing, scan
from kinfold.session import ensure_checkpoint_dir
from kinfold.sources import files, tables
from kinfold.sources.tables import table


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


def _object(rows: DataFrame, key: Column, value: Column) -> DataFrame:
    """One JSON object text with an entry per row; ``value`` is JSON text. For configuration-sized rows."""
    entry = F.concat(F.to_json(F.array(key)), F.lit(":"), value)
    name = F.regexp_replace(entry, r'^\["(.*?)"\]:', '"$1":')
    listed = F.array_join(F.array_sort(F.collect_list(name)), ",")
    return rows.agg(F.concat(F.lit("{"), listed, F.lit("}")).alias("value"))


def _text(rows: DataFrame, folder: str) -> str:
    rows.write.text(folder)
    return folder


def merged_id_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an ``old | new |`` line, with blank and broken lines between."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    line = F.concat(order.cast("string"), F.lit("\t| "), customer.cast("string"), F.lit(" |"))
    broken = F.when(order % 2 == 0, F.lit("")).otherwise(F.lit("x"))
    lines = table(spark, sf_dir, "orders").select(F.explode(F.array(line, broken)).alias("value"))
    return files.read_merged_ids(spark, _text(lines, shared_folder(spark)))


def id_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration line per customer, the list form for every second one, read back as settings."""
    key = F.col("c_custkey")
    example = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"), F.lit(":"), (key + 100).cast("string"))
    example = F.when(key % 2 == 0, F.concat(F.lit("["), example, F.lit("]"))).otherwise(example)
    line = F.concat(F.col("c_name"), F.lit("; ids ;  "), example)
    path = _text(table(spark, sf_dir, "customer").select(line.alias("value")), shared_folder(spark))
    return files.id_config_rows(spark, path).drop("place")


def saved_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers saved as records in two appends, then read back."""
    suppliers, folder = table(spark, sf_dir, "supplier"), shared_folder(spark)
    files.save_snapshot(Graph.of(empty(spark, "nodes")), folder)
    name = F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name"))
    for part in (0, 1):
        rows = scan.save_record(
            suppliers.filter(F.col("s_suppkey") % 2 == part), "SAVED", F.col("s_suppkey"), name=name, nation=F.col("s_nationkey")
        )
        files.append_nodes(rows, folder)
    nodes = files.load_label(spark, folder, "SAVED")
    return property_rows(nodes).select("id", "key", F.get("vals", F.lit(0)).alias("val"))


def policy_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and removed properties written for review, then read as a policy again."""
    folder = shared_folder(spark)
    schema = policy.node_schema(tables.table_graph(spark, sf_dir))
    files.write_policy(schema, filtering._pairs(spark, filtering.NODE_POLICY, "label"), f"{folder}/reviewed")
    reviewed = spark.read.schema("label string, kept_properties array<string>, removed_properties array<string>").json(f"{folder}/reviewed")
    body = F.to_json(F.struct("kept_properties", "removed_properties"))
    read = files.read_policy(spark, _text(_object(reviewed, F.col("label"), body), f"{folder}/policy"))
    return read.select("label", F.array_join("kept", ",").alias("kept"), F.array_join("removed", ",").alias("removed"), "malformed")


def valid_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specs over the graph of all tables, every second one with an unknown property; the valid ones stay."""
    schema = policy.node_schema(tables.table_graph(spark, sf_dir))
    metadata = accession.property_metadata(tables.table_graph(spark, sf_dir))
    first = schema.groupBy("label").agg(F.min("key").alias("key"))
    index = F.when(F.col("is_list"), F.lit(", \"index\": 0")).otherwise("")
    name = F.when(F.length("label") % 2 == 0, F.col("key")).otherwise(F.lit("unknown"))
    text = F.concat(
        F.lit('{"primary_accession": {"reasoning": "r", "property": "'), name, F.lit('"'), index,
        F.lit('}, "secondary_accessions": {"reasoning": "r", "properties": []}}'),
    )
    body = first.join(metadata, ["label", "key"])
    spec = files.read_accession_spec(spark, _text(_object(body, F.col("label"), text), shared_folder(spark)))
    return accession.valid_specs(spec, metadata).select("label", "property")


def safe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names of all part names, by brand: spaces become underscores, equal names get numbers."""
    key = F.concat(F.upper(F.substring("p_name", 1, 1)), F.substr("p_name", F.lit(2)), F.when(F.col("p_size") % 2 == 0, " ").otherwise("-"))
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("label"), key.alias("key"))
    return column_names(parts)


def sampled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two draws of the hash sample agree, and its share is near the rate."""
    keys = table(spark, sf_dir, "documents").select(F.col("source").alias("label"), F.col("doc_id").cast("string").alias("key"))
    drawn = keys.withColumn("first", routing.sampled(0.2)).repartition(3).withColumn("second", routing.sampled(0.2))
    share = F.avg(F.col("first").cast("double"))
    return drawn.agg(
        F.count("*").alias("n"), F.count_if(F.col("first") != F.col("second")).alias("differ"), share.between(0.1, 0.3).alias("near_rate")
    )


def identity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity groups, one object a line per supplier with its name and its nation, read back by row."""
    member = lambda label, key: F.struct(label.alias("nodelabel"), F.lit(key).alias("attribute"))
    nation = F.concat(F.lit("Src_"), F.col("s_nationkey").cast("string"))
    listed = F.array(member(F.lit("Src_Supplier"), "name"), member(nation, "ids"))
    lines = table(spark, sf_dir, "supplier").select(F.to_json(F.create_map(F.col("s_name"), listed)).alias("value"))
    rows = files.identity_group_rows(spark, _text(lines, shared_folder(spark)), lines=True)
    return rows.select("concept", F.col("pos").alias("place"), "label", "key")


def nested_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand and part → key, one object a line per part, as a list for every second one, read back by row."""
    key = F.col("p_partkey").cast("string")
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('["'), key, F.lit('","x"]'))).otherwise(F.concat(F.lit('"'), key, F.lit('"')))
    name = lambda column: F.concat(F.lit('{"'), column, F.lit('":'))
    line = F.concat(name(F.col("p_brand")), name(F.concat(F.lit("part "), key)), text, F.lit("}}"))
    lines = table(spark, sf_dir, "part").select(line.alias("value"))
    return files.read_nested_catalogue(spark, _text(lines, shared_folder(spark)), "brand", "part", lines=True)


QUERIES = {
    "merged_id_dump": merged_id_dump,
    "id_config": id_config,
    "saved_records": saved_records,
    "policy_round_trip": policy_round_trip,
    "valid_specs": valid_specs,
    "safe_columns": safe_columns,
    "sampled_scores": sampled_scores,
    "identity_groups": identity_groups,
    "nested_catalogue": nested_catalogue,
}

_KEPT = " UNION ALL ".join(f"SELECT '{label}' AS label, '{key}' AS key" for label, keys in filtering.NODE_POLICY.items() for key in keys)

ORACLES = {
    "merged_id_dump": 'SELECT o_orderkey AS old, o_custkey AS "new" FROM orders',
    "id_config": """
SELECT c_name AS label, 'ids' AS property, c_custkey % 2 = 0 AS is_list, 'N' || c_nationkey || ':' AS prefix FROM customer
""",
    "saved_records": """
SELECT s_suppkey AS id, 'nation' AS key, CAST(s_nationkey AS VARCHAR) AS val FROM supplier
UNION ALL SELECT s_suppkey, 'name', s_name FROM supplier WHERE s_suppkey % 3 > 0
""",
    "policy_round_trip": f"""
WITH s AS (SELECT DISTINCT label, key FROM ({sql.ALL_VALUES})), k AS ({_KEPT}),
j AS (SELECT s.label, s.key, k.key IS NOT NULL AS kept FROM s LEFT JOIN k USING (label, key))
SELECT label, coalesce(string_agg(key, ',' ORDER BY key) FILTER (kept), '') AS kept,
       coalesce(string_agg(key, ',' ORDER BY key) FILTER (NOT kept), '') AS removed, FALSE AS malformed FROM j GROUP BY label
""",
    "valid_specs": f"SELECT label, min(key) AS property FROM ({sql.ALL_VALUES}) WHERE length(label) % 2 = 0 GROUP BY label",
    "safe_columns": """
WITH k AS (SELECT DISTINCT p_brand AS label, upper(substr(p_name, 1, 1)) || substr(p_name, 2) || CASE WHEN p_size % 2 = 0 THEN ' ' ELSE '-' END AS key FROM part),
n AS (SELECT *, lower(regexp_replace(key, '[^a-zA-Z0-9_]', '_', 'g')) AS name FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY label, name ORDER BY key) - 1 AS nth FROM n)
SELECT label, key, CASE WHEN nth = 0 THEN name ELSE name || '_' || nth END AS "column" FROM r
""",
    "sampled_scores": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS differ, TRUE AS near_rate FROM documents",
    "identity_groups": """
SELECT s_name AS concept, 0 AS place, 'Src_Supplier' AS label, 'name' AS key FROM supplier
UNION ALL SELECT s_name, 1, 'Src_' || s_nationkey, 'ids' FROM supplier
""",
    "nested_catalogue": """
SELECT p_brand AS brand, 'part ' || p_partkey AS part, CAST(p_partkey AS VARCHAR) AS value FROM part
UNION ALL SELECT p_brand, 'part ' || p_partkey, 'x' FROM part WHERE p_partkey % 2 = 0
""",
}
