"""Clusters and concepts that grow by new records, without a run over the old ones.

The state of a clustering is two star tables: record to cluster and identifier value
to cluster. New records meet it in two semi joins on keys; only the clusters they
touch, each as its one root, take part in the rounds that follow.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.values import is_valid
from kinfold.model import MAPPED_TO, Graph, no_props, plus, props, scalar
from kinfold.operators.components import connected_components
from kinfold.operators.resolve import BLUEPRINTS, Blueprint, concept_node_id, filter_tables, identifier_rows, universal_id
from kinfold.session import ensure_checkpoint_dir
from kinfold.skew import checked_broadcast


@dataclass(frozen=True)
class Clusters:
    """``vertices``: vertex, component. ``values``: value, component. One row per vertex and per value."""

    vertices: DataFrame
    values: DataFrame


@dataclass(frozen=True)
class Growth:
    """What new members changed. ``replaced``: component, new of the stored clusters that now have another
    root; ``vertices`` and ``values``: the rows that are new; all of them in the checkpoint folder."""

    replaced: DataFrame
    vertices: DataFrame
    values: DataFrame


def no_clusters(members: DataFrame) -> Clusters:
    """The state before any member, in the types of ``members`` (vertex, value)."""
    none = members.filter("false")
    component = F.col("vertex").alias("component")
    return Clusters(none.select("vertex", component), none.select("value", component))


def touched_members(stored: Clusters, members: DataFrame) -> DataFrame:
    """The members that the rounds read: new ones, known vertices as the root of their cluster, and one row
    per known value of theirs with its root."""
    known = stored.vertices.join(members.select("vertex").distinct(), "vertex")
    own = members.join(known, "vertex", "left").select(F.coalesce("component", "vertex").alias("vertex"), "value")
    held = stored.values.join(members.select("value").distinct(), "value")
    return own.unionByName(held.select(F.col("component").alias("vertex"), "value")).distinct()


def grow(stored: Clusters, members: DataFrame) -> Growth:
    """Cluster new ``members`` (vertex, value) together with the stored clusters they touch.

    The stored tables are read by key only. A cluster's root stays its smallest
    vertex, so the clusters equal those of one run over all members, in whatever
    portions they come.
    """
    ensure_checkpoint_dir(members.sparkSession)
    members = members.select("vertex", "value").distinct().checkpoint()
    touched = touched_members(stored, members).checkpoint()
    roots = connected_components(touched).checkpoint()
    fresh = members.select("vertex").distinct().join(stored.vertices, "vertex", "left_anti")
    vertices = fresh.join(roots, "vertex").checkpoint()
    # A root that is no new vertex is that of a stored cluster.
    replaced = roots.join(vertices, "vertex", "left_anti").filter("vertex <> component")
    replaced = replaced.select(F.col("vertex").alias("component"), F.col("component").alias("new")).checkpoint()
    unknown = touched.join(stored.values, "value", "left_anti").join(roots, "vertex")
    return Growth(replaced, vertices, unknown.select("value", "component").distinct().checkpoint())


def grown(stored: Clusters, growth: Growth) -> Clusters:
    """The state after a growth: new rows added, rows of replaced clusters moved, all others passed through."""
    moved = checked_broadcast(growth.replaced)

    def table(old: DataFrame, added: DataFrame) -> DataFrame:
        kept = old.join(moved, "component", "left").withColumn("component", F.coalesce("new", "component"))
        return kept.select(*added.columns).unionByName(added)

    return Clusters(table(stored.vertices, growth.vertices), table(stored.values, growth.values))


def _members(rows: DataFrame) -> DataFrame:
    valid = rows.filter(is_valid(F.col("raw")) & F.col("std").isNotNull())
    return valid.select("vertex", F.struct("concept", "std").alias("value"))


def start(nodes: DataFrame, blueprints: Iterable[Blueprint] = BLUEPRINTS) -> Clusters:
    """No clusters yet, for these blueprints."""
    return no_clusters(_members(identifier_rows(nodes, blueprints)))


def integrate_more(
    graph: Graph, stored: Clusters, records: DataFrame, blueprints: Iterable[Blueprint] = BLUEPRINTS
) -> tuple[Graph, Clusters]:
    """Add ``records`` (nodes that the graph has not) and bring its concepts up to date.

    Same graph as ``resolve.integrate`` over all records at once. New clusters get a
    node; a cluster whose smallest member changed, or that merged into another, gives
    up its node, and its ``MAPPED_TO`` edges and merged ids go to the node
    in its place. Other edges of a node given up go with it, as a rebuild drops
    them. Concepts that no new record touches are passed through.
    """
    blueprints = list(blueprints)
    if any(blueprint.integrate for blueprint in blueprints):
        raise ValueError("merged ids of an integrate hook need all values of a cluster: use resolve.integrate")
    rows = identifier_rows(records, blueprints)
    growth = grow(stored, _members(rows))
    ids = growth.replaced.select(
        concept_node_id(F.col("component")).alias("given_up"),
        concept_node_id(F.col("new")).alias("instead"),
    )
    ids = checked_broadcast(ids, settle=True)
    found = rows.join(growth.vertices, "vertex").withColumn("concept_id", concept_node_id(F.col("component"))).checkpoint()

    without = filter_tables(
        graph,
        lambda table: table.join(ids.select(F.col("given_up").alias("id")), "id", "left_anti"),
        lambda table: table.join(ids.select(F.col("given_up").alias("src")), "src", "left_anti").join(
            ids.select(F.col("given_up").alias("dst")), "dst", "left_anti"
        ),
    )
    label = F.array("concept")
    # Clusters that have no node yet: those of new roots.
    made = growth.vertices.select("component").unionByName(growth.replaced.select(F.col("new").alias("component"))).distinct()
    made = made.filter("component IS NOT NULL").select(
        F.col("component.concept").alias("concept"), concept_node_id(F.col("component")).alias("id"), universal_id(F.col("component")).alias("uid")
    )
    made = made.join(without.nodes.select("id"), "id", "left_anti")
    nodes = made.select(
        "id", label.alias("labels"), props(universal_id=scalar(F.col("uid")), mapped=scalar(F.lit("true"), "Boolean")).alias("props")
    )
    kept = graph.edges.filter(F.col("rel") == MAPPED_TO).join(ids.withColumnRenamed("given_up", "dst"), "dst")
    moved = kept.withColumn("dst", F.col("instead"))
    mapped = found.select("concept", "id", "labels", "concept_id").distinct().select(
        F.col("id").alias("src"), F.col("labels").alias("src_labels"), F.col("concept_id").alias("dst"),
        label.alias("dst_labels"), F.lit(MAPPED_TO).alias("rel"), no_props().alias("props"),
    )
    values = found.filter("on_head AND raw IS NOT NULL").select(
        F.col("concept_id").alias("id"), label.alias("labels"), F.lit("merged_ids").alias("key"),
        F.lit("String").alias("dtype"), F.lit(None).cast("bigint").alias("pos"), F.col("raw").cast("string").alias("val"),
    )
    # Values of touched clusters only can repeat: those moved, those added, and those already at the same node.
    old = graph.table("node_values")
    carried = old.join(ids.withColumnRenamed("given_up", "id"), "id").withColumn("id", F.col("instead")).select(*values.columns)
    added = values.unionByName(carried).distinct()
    present = without.table("node_values").join(added.select("id").distinct(), "id", "left_semi")
    added = added.join(present.select("id", "key", "val"), ["id", "key", "val"], "left_anti")
    result = without.with_(
        nodes=plus(without.nodes, records.select(*without.nodes.columns), nodes),
        edges=plus(without.edges, moved.select(*without.edges.columns), mapped),
        node_values=plus(without.node_values, added),
    )
    return result, grown(stored, growth)
