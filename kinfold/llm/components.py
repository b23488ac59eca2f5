"""Connected components over an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.session import ensure_checkpoint_dir


def settled(frame: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder.

    Later uses read them back instead of working them out again, a lost executor
    costs nothing before this point, and a join over the result gets a fresh
    exchange on this side, so that adaptive execution can split a hot key.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node of its component) for every node of an edge.

    ``edges`` has ``a`` and ``b`` of one orderable type; order, repeats and loops
    do not matter, rows with a null end are left out. Large-star and small-star
    rounds (Kiveris et al., 2014) run until an edge list no longer changes.
    """
    edges = edges.filter("a is not null and b is not null and a <> b")
    edges = settled(edges.select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")).distinct())
    mark = _mark(edges)
    while mark[0]:
        edges = settled(_small_star(settled(_large_star(edges))))
        if (now := _mark(edges)) == mark:
            break
        mark = now
    roots = edges.select("small").distinct().select(F.col("small").alias("node"), F.col("small").alias("component"))
    return edges.select(F.col("big").alias("node"), F.col("small").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and the sum of their hashes: two equal lists have equal marks."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the smallest node among the node and its neighbours."""
    ends = edges.unionByName(edges.select(F.col("small").alias("big"), F.col("big").alias("small")))
    least = ends.groupBy(F.col("big").alias("small")).agg(F.min("small").alias("_least"))
    least = settled(least.select("small", F.least("small", "_least").alias("_least")))
    return edges.join(least, "small").select("big", F.col("_least").alias("small")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours get the smallest of them."""
    least = settled(edges.groupBy("big").agg(F.min("small").alias("_least")))
    moved = edges.join(least, "big").filter("small <> _least")
    return (
        moved.select(F.col("small").alias("big"), F.col("_least").alias("small"))
        .unionByName(least.select("big", F.col("_least").alias("small")))
        .distinct()
    )
