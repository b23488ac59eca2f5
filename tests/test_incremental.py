import random

import pytest
from graphs import graph, rows
from pyspark.sql import functions as F

from kinfold.model import Graph, value_rows
from kinfold.operators import incremental, resolve
from kinfold.operators.components import connected_components
from kinfold.operators.resolve import Blueprint

THING = Blueprint("THING", {"a": ("A_x", "k"), "b": ("B_y", "k")})
OTHER = Blueprint("OTHER", {"a": ("A_x", "m")})


def frame(spark, members):
    return spark.createDataFrame(members, "vertex bigint, value string")


@pytest.mark.parametrize("seed", [1, 2])
def test_portions_equal_one_run(spark, seed):
    rng = random.Random(seed)
    members = [(rng.randint(0, 30), f"v{rng.randint(0, 25)}") for _ in range(45)]
    rng.shuffle(members)  # vertices come back in later portions with more values
    state = incremental.no_clusters(frame(spark, members))
    for part in (members[:15], members[15:15], members[15:30], members[30:]):
        growth = incremental.grow(state, frame(spark, part))
        state = incremental.grown(state, growth)
        state = incremental.Clusters(state.vertices.checkpoint(), state.values.checkpoint())
    want = connected_components(frame(spark, members))
    assert rows(state.vertices) == rows(want)
    by_value = frame(spark, members).join(want, "vertex").select("value", "component").distinct()
    assert rows(state.values) == rows(by_value)


def test_rounds_read_touched_rows_only(spark, monkeypatch):
    old = [(i, f"v{i // 3}") for i in range(3_000)]
    growth = incremental.grow(incremental.no_clusters(frame(spark, old)), frame(spark, old))
    state = incremental.grown(incremental.no_clusters(frame(spark, old)), growth)
    seen = []
    monkeypatch.setattr(incremental, "connected_components", lambda m: seen.append(m.count()) or connected_components(m))
    growth = incremental.grow(state, frame(spark, [(5_000, "v7"), (5_000, "v900"), (-1, "v7"), (6_000, "own")]))
    assert seen == [6]  # four new members and the roots of v7 and v900
    assert rows(growth.replaced) == [(21, -1), (2_700, -1)]
    assert rows(growth.vertices) == [(-1, -1), (5_000, -1), (6_000, 6_000)]
    assert rows(growth.values) == [("own", 6_000)]


def canonical(g):
    nodes = sorted((r.id, tuple(r.labels), sorted((k, p.dtype, tuple(p.vals)) for k, p in r.props.items())) for r in g.nodes.collect())
    edges = sorted((r.src, tuple(r.src_labels), r.rel, r.dst, tuple(r.dst_labels)) for r in g.edges.collect())
    return nodes, edges, rows(value_rows(g).filter("id < 0").select("id", "key", "dtype", "val"))


def test_concepts_equal_one_run(spark):
    rng = random.Random(4)
    nodes = []
    for i in rng.sample(range(100), 24):
        labels = rng.choice([["A_x"], ["B_y"], ["Z_z", "A_x"]])
        nodes.append((i, labels, {"k": [rng.choice(["n/a", "", *(f"v{j}" for j in range(14))]) for _ in range(rng.randint(0, 3))], "m": f"m{i % 9}"}))
    blueprints = [THING, OTHER]
    whole = graph(spark, nodes, [(nodes[0][0], "SEES", nodes[1][0])])
    want = resolve.integrate(whole, blueprints)
    result = Graph.of(whole.nodes.limit(0), whole.edges)
    state = incremental.start(whole.nodes, blueprints)
    for part in (nodes[:10], nodes[10:18], nodes[18:]):
        records = whole.nodes.filter(F.col("id").isin([n[0] for n in part]))
        result, state = incremental.integrate_more(result, state, records, blueprints)
        result = Graph(result.nodes.checkpoint(), result.edges.checkpoint(), result.node_values.checkpoint())
        state = incremental.Clusters(state.vertices.checkpoint(), state.values.checkpoint())
    assert canonical(result) == canonical(want)


def test_edges_of_a_concept_given_up_go(spark):
    first = graph(spark, [(5, ["A_x"], {"k": "v"})])
    g, state = incremental.integrate_more(Graph.of(first.nodes.limit(0)), incremental.start(first.nodes, [THING]), first.nodes, [THING])
    concept = g.edges.first().dst
    link = g.edges.withColumn("rel", F.lit("LINK"))
    g = g.with_(edges=g.edges.unionByName(link))
    more = graph(spark, [(3, ["B_y"], {"k": "v"}), (9, ["B_y"], {})])
    g, state = incremental.integrate_more(g, state, more.nodes, [THING])
    assert rows(g.edges.select("src", "rel").orderBy("src")) == [(3, "MAPPED_TO"), (5, "MAPPED_TO")]
    assert concept not in [row.id for row in g.nodes.collect()] and g.nodes.count() == 4
