"""Paths over several edges whose nodes bear given labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.model import Graph
from kinfold.session import ensure_checkpoint_dir


def hop(edges: DataFrame, first: str, second: str, place: int) -> DataFrame:
    """(n<place>, n<place + 1>) per edge between the two labels, either direction; a self loop once."""
    names = f"n{place}", f"n{place + 1}"

    def side(one: str, two: str) -> DataFrame:
        rows = edges.filter(F.array_contains(f"{one}_labels", first) & F.array_contains(f"{two}_labels", second))
        return rows.select(F.col(one).alias(names[0]), F.col(two).alias(names[1]))

    return side("src", "dst").unionByName(side("dst", "src").filter(F.col(names[0]) != F.col(names[1])))


def reduced_hops(graph: Graph, labels: Sequence[str]) -> list[DataFrame]:
    """The edges of each step that lie on a complete path, in the checkpoint folder.

    A pass forward keeps the edges that some path reaches, a pass back those
    from which one gets to the end. Each is a semi join on distinct node ids, so
    nothing grows, and what lies on no complete path meets no join.
    """
    if len(labels) < 2:
        raise ValueError("a path has at least two labels")
    ensure_checkpoint_dir(graph.edges.sparkSession)
    hops = [hop(graph.edges, first, second, place) for place, (first, second) in enumerate(zip(labels, labels[1:]))]
    for place in range(1, len(hops)):
        hops[place - 1] = hops[place - 1].checkpoint()
        hops[place] = hops[place].join(hops[place - 1].select(f"n{place}").distinct(), f"n{place}", "left_semi")
    hops[-1] = hops[-1].checkpoint()
    for place in range(len(hops) - 1, 0, -1):
        hops[place - 1] = hops[place - 1].join(hops[place].select(f"n{place}").distinct(), f"n{place}", "left_semi").checkpoint()
    return [step.select(f"n{place}", f"n{place + 1}") for place, step in enumerate(hops)]


def paths(graph: Graph, labels: Sequence[str]) -> DataFrame:
    """(n0, n1, ...): one row per path whose nodes bear the labels in order; parallel edges give a path each.

    As many rows as there are paths, all of them; both sides of each join are
    fresh exchanges, which adaptive execution deals out where a node is hot. A
    path may come back to a node, and a node may bear several of the labels.
    """
    hops = reduced_hops(graph, labels)
    found = hops[0]
    for place, step in enumerate(hops[1:], 1):
        found = found.join(step, f"n{place}")
    return found.select(*(f"n{place}" for place in range(len(labels))))
