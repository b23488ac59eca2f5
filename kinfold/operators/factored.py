"""Value links lifted to concepts without listing them.

A value held by m sources and n targets stands for m x n links. After the source
nodes are deleted only what the links became at the concepts is left, and
combining keeps one edge per pair of nodes. So members are moved to their concepts
first and counted there, and only then paired: a hub of any size gives one row per
pair of different concepts, with the number of links it stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.values import is_source_node
from kinfold.model import COLUMNS, Graph, listing, plus, put
from kinfold.operators.link import EdgeDefinition, link_facts, link_members
from kinfold.operators.propagate import mapping_pairs
from kinfold.session import ensure_checkpoint_dir

HUB = ["definition", "rel", "hub"]


def lifted_members(
    members: DataFrame, mapped: DataFrame, facts: Column, surviving: bool = True, both_orientations: bool = False
) -> DataFrame:
    """Edges with a column ``n``: what ``lifted_edges`` makes of the listed links, equal edges as one row.

    ``members`` are those of ``link.link_members``, ``facts`` gives a link's
    properties from the hub, ``mapped`` the concepts. Besides pairs of concepts
    these are edges between a concept and an unmapped member, and the links
    themselves; with ``surviving`` only where the deletion of source nodes would leave them.
    A member with k concepts counts at each. No link joins a member to itself.
    """
    ensure_checkpoint_dir(members.sparkSession)
    concepts = mapped.select(
        F.col("src").alias("id"), F.col("dst").alias("anchor"), F.col("dst_labels").alias("anchor_labels")
    )
    placed = members.join(concepts, "id", "left").checkpoint()
    own = placed.filter("anchor <> id")
    counted = own.groupBy(*HUB, "side", "labels", "anchor", "anchor_labels").agg(F.count("*").alias("n")).checkpoint()
    alone = members if not surviving else members.filter(~is_source_node(F.col("labels")))
    open_ = placed.filter("anchor IS NULL")
    open_ = open_ if not surviving else open_.filter(~is_source_node(F.col("labels")))

    def side(rows: DataFrame, which: str, node: str, node_labels: str, n: Column) -> DataFrame:
        return rows.filter(F.col("side") == which).select(
            *HUB,
            F.col(node).alias(which),
            F.col(node_labels).alias(f"{which}_labels"),
            F.col("labels").alias(f"{which}_member"),
            n.alias(f"{which}_n"),
        )

    def at_concepts(which: str) -> DataFrame:
        return side(counted, which, "anchor", "anchor_labels", F.col("n"))

    def at_members(rows: DataFrame, which: str) -> DataFrame:
        return side(rows, which, "id", "labels", F.lit(1))

    def made(pairs: DataFrame, first: str | None, second: str | None, n: Column = F.col("src_n") * F.col("dst_n")) -> DataFrame:
        properties = facts
        if first:
            properties = put(facts, source_labels=listing(F.col(first)), target_labels=listing(F.col(second)))
        return pairs.select("src", "src_labels", "dst", "dst_labels", "rel", properties.alias("props"), n.alias("n"))

    # Links of a member to itself are in the product of the counts, but are none.
    key = [*HUB, "src", "dst", "src_member", "dst_member"]
    itself = (
        own.filter("side = 'src'")
        .select(*HUB, "id", F.col("anchor").alias("src"), F.col("labels").alias("src_member"))
        .join(own.filter("side = 'dst'").select(*HUB, "id", F.col("anchor").alias("dst"), F.col("labels").alias("dst_member")), [*HUB, "id"])
        .groupBy(*key)
        .agg(F.count("*").alias("itself"))
    )
    across = at_concepts("src").join(at_concepts("dst"), HUB).filter("src <> dst").join(itself, key, "left")
    across = across.withColumn("links", F.col("src_n") * F.col("dst_n") - F.coalesce("itself", F.lit(0))).filter("links > 0")
    found = [
        made(across, "src_member", "dst_member", F.col("links")),
        made(at_concepts("src").join(at_members(open_, "dst"), HUB).filter("src <> dst"), "src_member", "dst_member"),
        made(at_members(open_, "src").join(at_concepts("dst"), HUB).filter("src <> dst"), "dst_member", "src_member"),
        made(at_members(alone, "src").join(at_members(alone, "dst"), HUB).filter("src <> dst"), None, None),
    ]
    if both_orientations:
        found.append(made(across, "dst_member", "src_member", F.col("links")))
    every = plus(*found)
    return every.select(*COLUMNS["edges"], F.col("n").cast("bigint").alias("n"))


def lifted_links(graph: Graph, definition: EdgeDefinition, **options) -> DataFrame:
    """``lifted_members`` for the links of one definition over a graph that does not list them."""
    return lifted_members(link_members(graph, definition), mapping_pairs(graph.edges), link_facts(definition, F.col("hub")), **options)
