"""Adapter: the supplied tables as a property graph.

An id is ``key * 16 + kind``, so ids of different kinds never meet, whatever the
number of rows. Brand and part type have no key; theirs is the first 52 bits of
the MD5 of the value. No join or shuffle is needed to give an id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from kinfold.model import MAPPED_TO, PROPS, Graph

KINDS = {
    "Src_Customer": 1,
    "Src_Supplier": 2,
    "Src_Order": 3,
    "Src_Part": 4,
    "NATION": 5,
    "BRAND": 6,
    "PART_TYPE": 7,
    "Src_Document": 8,
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table; its schema is read from the file footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def node_id(label: str, key: Column) -> Column:
    return key.cast("bigint") * 16 + KINDS[label]


def _id(label: str, key: str) -> str:
    return f"CAST({key} AS BIGINT) * 16 + {KINDS[label]}"


def _value_id(label: str, value: str) -> str:
    return _id(label, f"conv(substr(md5({value}), 1, 13), 16, 10)")


def _scalar(value: str, dtype: str = "String") -> str:
    return f"named_struct('dtype', '{dtype}', 'is_list', false, 'vals', array(CAST({value} AS STRING)))"


def _listing(values: str, dtype: str = "String") -> str:
    return f"named_struct('dtype', '{dtype}', 'is_list', true, 'vals', CAST({values} AS ARRAY<STRING>))"


def _props(properties: dict[str, str]) -> str:
    if not properties:
        return f"CAST(map() AS {PROPS})"
    pairs = ", ".join(f"'{key}', {value}" for key, value in properties.items())
    return f"map({pairs})"


def _nodes(rows: DataFrame, label: str, record_id: str, **properties: str) -> DataFrame:
    return rows.selectExpr(
        f"{record_id} AS id", f"array('{label}') AS labels", f"{_props(properties)} AS props"
    )


def customer_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(
        table(spark, sf_dir, "customer"),
        "Src_Customer",
        _id("Src_Customer", "c_custkey"),
        id=_scalar("concat('CUST:', c_custkey)"),
        name=_scalar("c_name"),
        segment=_scalar("c_mktsegment"),
        nationkey=_scalar("c_nationkey", "Long"),
    )


def supplier_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(
        table(spark, sf_dir, "supplier"),
        "Src_Supplier",
        _id("Src_Supplier", "s_suppkey"),
        id=_scalar("concat('SUPP:', s_suppkey)"),
        name=_scalar("s_name"),
        nationkey=_scalar("s_nationkey", "Long"),
    )


def order_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(
        table(spark, sf_dir, "orders"),
        "Src_Order",
        _id("Src_Order", "o_orderkey"),
        status=_scalar("o_orderstatus"),
        priority=_scalar("o_orderpriority"),
    )


def part_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(
        table(spark, sf_dir, "part"),
        "Src_Part",
        _id("Src_Part", "p_partkey"),
        name=_scalar("p_name"),
        words=_listing("split(p_name, ' ')"),
        size=_scalar("p_size", "Long"),
    )


def nation_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(
        table(spark, sf_dir, "nation"),
        "NATION",
        _id("NATION", "n_nationkey"),
        ids=_listing("array(concat('NATION:', n_nationkey), concat('REGION:', n_regionkey))"),
        names=_listing("array(n_name)"),
    )


def value_nodes(spark: SparkSession, sf_dir: str, label: str, column: str) -> DataFrame:
    values = table(spark, sf_dir, "part").select(column).distinct()
    return _nodes(values, label, _value_id(label, column), names=_listing(f"array({column})"))


def document_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(
        table(spark, sf_dir, "documents"),
        "Src_Document",
        _id("Src_Document", "doc_id"),
        text_md5=_scalar("md5(text)"),
        letters_md5=_scalar("md5(concat('letters ', regexp_replace(lower(text), '[^a-z]', '')))"),
        lang=_scalar("lang"),
        source=_scalar("source"),
    )


def _edges(
    rows: DataFrame, rel: str, src: tuple[str, str], dst: tuple[str, str], **properties: str
) -> DataFrame:
    """``src`` and ``dst`` are label and id expression."""
    return rows.selectExpr(
        f"{src[1]} AS src",
        f"array('{src[0]}') AS src_labels",
        f"{dst[1]} AS dst",
        f"array('{dst[0]}') AS dst_labels",
        f"'{rel}' AS rel",
        f"{_props(properties)} AS props",
    )


def mapping_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    part_end = ("Src_Part", _id("Src_Part", "p_partkey"))
    return reduce(
        DataFrame.union,
        [
            _edges(
                table(spark, sf_dir, "customer"),
                MAPPED_TO,
                ("Src_Customer", _id("Src_Customer", "c_custkey")),
                ("NATION", _id("NATION", "c_nationkey")),
            ),
            _edges(
                table(spark, sf_dir, "supplier"),
                MAPPED_TO,
                ("Src_Supplier", _id("Src_Supplier", "s_suppkey")),
                ("NATION", _id("NATION", "s_nationkey")),
            ),
            _edges(part, MAPPED_TO, part_end, ("BRAND", _value_id("BRAND", "p_brand"))),
            _edges(part, MAPPED_TO, part_end, ("PART_TYPE", _value_id("PART_TYPE", "p_type"))),
        ],
    )


def placed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(
        table(spark, sf_dir, "orders"),
        "PLACED",
        ("Src_Customer", _id("Src_Customer", "o_custkey")),
        ("Src_Order", _id("Src_Order", "o_orderkey")),
    )


def line_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(
        table(spark, sf_dir, "lineitem"),
        "HAS_LINE",
        ("Src_Order", _id("Src_Order", "l_orderkey")),
        ("Src_Part", _id("Src_Part", "l_partkey")),
        linenumber=_scalar("l_linenumber", "Long"),
        quantity=_scalar("l_quantity", "Double"),
    )


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(
        table(spark, sf_dir, "lineitem"),
        "SUPPLIED_BY",
        ("Src_Part", _id("Src_Part", "l_partkey")),
        ("Src_Supplier", _id("Src_Supplier", "l_suppkey")),
        returnflag=_scalar("l_returnflag"),
        linestatus=_scalar("l_linestatus"),
    )


def table_graph(spark: SparkSession, sf_dir: str) -> Graph:
    nodes = reduce(
        DataFrame.union,
        [
            customer_nodes(spark, sf_dir),
            supplier_nodes(spark, sf_dir),
            order_nodes(spark, sf_dir),
            part_nodes(spark, sf_dir),
            nation_nodes(spark, sf_dir),
            value_nodes(spark, sf_dir, "BRAND", "p_brand"),
            value_nodes(spark, sf_dir, "PART_TYPE", "p_type"),
        ],
    )
    edges = reduce(
        DataFrame.union,
        [
            mapping_edges(spark, sf_dir),
            placed_edges(spark, sf_dir),
            line_edges(spark, sf_dir),
            supply_edges(spark, sf_dir),
        ],
    )
    return Graph.of(nodes, edges)
