"""Schema summary and property profile."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.catalog import sql
from kinfold.catalog.propagation import mapped_graph
from kinfold.operators import accession, combine, profile, propagate
from kinfold.sources import tables
from kinfold.sources.files import parse_accession_spec


def schema_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.schema_edges(tables.table_graph(spark, sf_dir))


def property_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.property_usage(tables.table_graph(spark, sf_dir))


def edge_property_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.edge_property_types(tables.table_graph(spark, sf_dir)).select("rel", "key", "type")


def schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.schema_counts(tables.table_graph(spark, sf_dir))


def property_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = tables.table_graph(spark, sf_dir)
    return profile.property_profile(graph).withColumn("n", F.col("n").cast("bigint"))


def merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of the concepts after the roll-up: long lists are cut."""
    graph = propagate.property_roll_up(mapped_graph(spark, sf_dir))
    keys = spark.createDataFrame([("names",), ("Src_Customer__name",), ("Src_Customer__nationkey",)], "key string")
    rows = profile.property_profile(graph, limit=3, concept_only=True, keys=keys)
    return rows.withColumn("n", F.col("n").cast("bigint"))


def final_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of all node and edge properties after combining edges and assigning accessions."""
    graph = combine.combine_edges(tables.table_graph(spark, sf_dir))
    entry = {"secondary_accessions": {"properties": ["names", "words"], "reasoning": "r"}}
    wanted = {"Src_Customer": ("id", None), "Src_Part": ("words", 1), "NATION": ("ids", None), "BRAND": ("names", 0)}
    specs = [
        (i, label, json.dumps(entry | {"primary_accession": {"property": prop, "index": index, "reasoning": "r"}}))
        for i, (label, (prop, index)) in enumerate(wanted.items())
    ]
    spec = parse_accession_spec(spark.createDataFrame(specs, "ord int, label string, json string"))
    done = accession.apply_accessions(graph, spec)
    nodes = profile.node_property_types(done).select(F.lit("node").alias("part"), F.col("label").alias("name"), "key", "types")
    edges = profile.edge_property_types(done).select(F.lit("edge").alias("part"), F.col("rel").alias("name"), "key", "types")
    return nodes.unionByName(edges).withColumn("types", F.array_join("types", ","))


def sample_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sample_types(tables.table_graph(spark, sf_dir))


def local_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.local_connections(tables.table_graph(spark, sf_dir))


def unmapped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = profile.unmapped_labels(tables.table_graph(spark, sf_dir))
    return labels.select(F.array_join("labels", ",").alias("label"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.catalogue(tables.table_graph(spark, sf_dir))


def wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = profile.wide_view(tables.table_graph(spark, sf_dir), "Src_Part")
    return wide.select("id", "name", "size", F.array_join("words", " ").alias("words"))


QUERIES = {
    "schema_edges": schema_edges,
    "property_usage": property_usage,
    "edge_property_types": edge_property_types,
    "schema_counts": schema_counts,
    "property_profile": property_profile,
    "merged_profile": merged_profile,
    "final_schema": final_schema,
    "sample_types": sample_types,
    "local_connections": local_connections,
    "unmapped_labels": unmapped_labels,
    "catalogue": catalogue,
    "wide_view": wide_view,
}

_TYPES = f"""
v AS ({sql.ALL_VALUES}),
t AS (SELECT label, key, min(dtype || CASE WHEN is_list THEN 'Array' ELSE '' END) AS type FROM v GROUP BY label, key)
"""
_EDGES = f"e AS (SELECT DISTINCT src_label, rel, dst_label FROM ({sql.EDGES}))"
_SHOWN = """
q AS (SELECT *, row_number() OVER (PARTITION BY id, label, key ORDER BY pos) AS place,
             count(*) OVER (PARTITION BY id, label, key) AS len FROM v),
s AS (SELECT id, label, key,
             CASE WHEN bool_or(is_list)
                  THEN '[' || string_agg(CASE WHEN dtype = 'String' THEN '''' || val || '''' ELSE val END, ', ' ORDER BY pos)
                       || CASE WHEN max(len) > 5 THEN ', ...]' ELSE ']' END
                  ELSE min(val) END AS sample
      FROM q WHERE place <= 5 GROUP BY id, label, key),
f AS (SELECT label, key, row_number() OVER (PARTITION BY label, key ORDER BY id) AS n, sample FROM s)
"""

ORACLES = {
    "schema_edges": f"WITH {_EDGES} SELECT src_label AS start_label, rel, dst_label AS end_label FROM e",
    "property_usage": f"""
WITH {_TYPES} SELECT key, label, min(type) OVER (PARTITION BY key) AS type FROM t
""",
    "edge_property_types": """
WITH t AS (SELECT DISTINCT 'HAS_LINE' AS rel, 'linenumber' AS key, typeof(l_linenumber) AS stored FROM lineitem
           UNION SELECT 'HAS_LINE', 'quantity', typeof(l_quantity) FROM lineitem
           UNION SELECT 'SUPPLIED_BY', 'returnflag', typeof(l_returnflag) FROM lineitem
           UNION SELECT 'SUPPLIED_BY', 'linestatus', typeof(l_linestatus) FROM lineitem)
SELECT rel, key, CASE stored WHEN 'INTEGER' THEN 'Long' WHEN 'BIGINT' THEN 'Long' WHEN 'DOUBLE' THEN 'Double' ELSE 'String' END AS type FROM t
""",
    "schema_counts": f"""
WITH {_TYPES}, {_EDGES}
SELECT 'node_properties' AS what, count(*) AS n FROM t
UNION ALL SELECT 'edge_properties', count(*) FROM ({sql.EDGE_KEYS})
UNION ALL SELECT 'schema_edges', count(*) FROM e
UNION ALL SELECT 'property_keys', count(DISTINCT key) FROM t
UNION ALL SELECT 'labels', count(DISTINCT label) FROM ({sql.NODES})
UNION ALL SELECT 'relations', count(DISTINCT rel) FROM e
""",
    "property_profile": f"""
WITH {_TYPES}, {_SHOWN}
SELECT label, key, type, n, sample FROM f JOIN t USING (label, key) WHERE n <= 5
""",
    "merged_profile": f"""
WITH m AS ({sql.MAPPED}),
r AS (SELECT DISTINCT m.dst AS id, m.dst_label AS label, x.label || '__' || x.key AS key, x.dtype, TRUE AS is_list, x.val
      FROM ({sql.CUSTOMER_VALUES}) x JOIN m ON m.src = x.id WHERE x.key IN ('name', 'nationkey')),
v AS (SELECT *, row_number() OVER (PARTITION BY id, key ORDER BY val) AS pos FROM r
      UNION ALL BY NAME SELECT * FROM ({sql.CONCEPT_VALUES}) WHERE key = 'names'),
{_SHOWN}
SELECT label, key, CASE key WHEN 'Src_Customer__nationkey' THEN 'LongArray' ELSE 'StringArray' END AS type, n, sample
FROM f WHERE n <= 3
""",
    "final_schema": f"""
WITH v AS ({sql.ALL_VALUES}),
t AS (SELECT DISTINCT label AS name, key, dtype || CASE WHEN is_list THEN 'Array' ELSE '' END AS type FROM v
      UNION SELECT DISTINCT label, 'primary_accession',
                   CASE WHEN label = 'NATION' THEN 'StringArray' ELSE 'String' END FROM v WHERE label IN ('Src_Customer', 'Src_Part', 'NATION', 'BRAND')
      UNION SELECT DISTINCT label, 'secondary_accession', 'StringArray' FROM v
            WHERE label IN ('Src_Customer', 'Src_Part', 'NATION', 'BRAND') AND key IN ('names', 'words')),
x AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem),
lines AS (SELECT 'HAS_LINE' AS name, 'linenumber' AS key, 'Long' AS dtype, count(DISTINCT l_linenumber) AS n FROM x GROUP BY l_orderkey, l_partkey
          UNION ALL SELECT 'HAS_LINE', 'quantity', 'Double', count(DISTINCT l_quantity) FROM x GROUP BY l_orderkey, l_partkey
          UNION ALL SELECT 'SUPPLIED_BY', 'returnflag', 'String', count(DISTINCT l_returnflag) FROM x GROUP BY l_partkey, l_suppkey
          UNION ALL SELECT 'SUPPLIED_BY', 'linestatus', 'String', count(DISTINCT l_linestatus) FROM x GROUP BY l_partkey, l_suppkey),
e AS (SELECT DISTINCT name, key, dtype || CASE WHEN n > 1 THEN 'Array' ELSE '' END AS type FROM lines)
SELECT 'node' AS part, name, key, string_agg(type, ',' ORDER BY type) AS types FROM t GROUP BY name, key
UNION ALL SELECT 'edge', name, key, string_agg(type, ',' ORDER BY type) FROM e GROUP BY name, key
""",
    "sample_types": f"""
WITH {_TYPES}
SELECT label, key, CASE type WHEN 'Long' THEN 'Integer' WHEN 'StringArray' THEN 'List' ELSE type END AS data_type FROM t
""",
    "local_connections": f"""
WITH {_EDGES}, c AS (SELECT src_label AS label, 'out' AS direction, rel, dst_label AS other,
    '(:`' || src_label || '`)-[:`' || rel || '`]->(:`' || dst_label || '`)' AS connection FROM e
    UNION ALL SELECT dst_label, 'in', rel, src_label,
    '(:`' || src_label || '`)-[:`' || rel || '`]->(:`' || dst_label || '`)' FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY label, direction ORDER BY rel, other) AS n FROM c)
SELECT label, direction, connection FROM r WHERE n <= 30
""",
    "unmapped_labels": f"""
WITH n AS ({sql.NODES}), m AS ({sql.MAPPED})
SELECT DISTINCT label FROM n WHERE id NOT IN (SELECT src FROM m UNION ALL SELECT dst FROM m)
""",
    "catalogue": f"WITH {_TYPES} SELECT label, key, type AS declared FROM t",
    "wide_view": f"SELECT {sql.PART} AS id, p_name AS name, CAST(p_size AS BIGINT) AS size, p_name AS words FROM part",
}
