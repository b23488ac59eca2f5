import random

import pytest
from graphs import graph
from pyspark.sql import functions as F

from kinfold.model import COLUMNS, Graph
from kinfold.operators import combine, factored, link, propagate
from kinfold.operators.link import EdgeDefinition

LINK = EdgeDefinition("Src_A", "k", "Src_B", "k", "LINK")


def canonical(result):
    edges = sorted(
        (row.src, row.rel, row.dst, tuple(row.src_labels), tuple(row.dst_labels), sorted((k, p.is_list, tuple(p.vals)) for k, p in row.props.items()))
        for row in result.edges.collect()
    )
    values = result.edge_values
    return edges, sorted((r.src, r.rel, r.dst, tuple(r.src_labels), tuple(r.dst_labels), r.key, r.dtype, r.is_list, r.val) for r in values.collect())


def mixed(spark, seed):
    """Sources and targets, some both, some survivors, mapped to none, one or several concepts, and other edges."""
    rng = random.Random(seed)
    nodes = [(100 + i, ["CONCEPT" if i % 2 else "OTHER"], {}) for i in range(5)]
    edges = []
    for i in range(26):
        labels = rng.choice([["Src_A"], ["Src_B"], ["Src_A", "Src_B"], ["KEPT", "Src_A"], ["KEPT", "Src_B"], ["KEPT", "Src_B", "Src_A"]])
        nodes.append((i, labels, {"k": [f"v{rng.randint(0, 5)}" for _ in range(rng.randint(0, 2))], "name": f"n{i}"}))
        for _ in range(rng.choice([0, 1, 1, 2])):
            edges.append((i, "MAPPED_TO", 100 + rng.randint(0, 4)))
    edges += [(rng.randint(0, 25), "LINK", rng.randint(0, 25), {"own": "x"}) for _ in range(12)]
    edges.append((101, "MAPPED_TO", 101))
    return graph(spark, nodes, edges)


@pytest.mark.parametrize("seed, both", [(1, False), (2, False), (3, True)])
def test_equals_listed_links(spark, seed, both):
    given = mixed(spark, seed)
    listed = combine.combine_edges(propagate.propagate(link.link(given, LINK), both_orientations=both))
    lifted = factored.lifted_links(given, LINK, both_orientations=both)
    result = combine.combine_edges(propagate.propagate(given, both_orientations=both), lifted)
    assert canonical(result) == canonical(listed)
    assert canonical(result)[1]


def test_without_deletion(spark):
    """All that the listed links become, before anything is deleted: as many edges, equal ones counted."""
    given = mixed(spark, 7)
    only = Graph.of(given.nodes, given.edges.filter("rel = 'MAPPED_TO'"))
    links = link.value_links(only, LINK)
    annotated = propagate.with_concepts(links, propagate.mapping_pairs(only.edges))
    listed = links.unionByName(propagate.lifted_edges(annotated))
    text = F.to_json(F.struct(*[F.col(name) for name in COLUMNS["edges"] if name != "props"], F.array_sort(F.map_entries("props"), lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(1)).alias("p")))
    want = {row.text: row.n for row in listed.select(text.alias("text")).groupBy("text").agg(F.count("*").alias("n")).collect()}
    lifted = factored.lifted_links(only, LINK, surviving=False)
    got = {row.text: row.n for row in lifted.select(text.alias("text"), "n").groupBy("text").agg(F.sum("n").alias("n")).collect()}
    assert got == want


def test_a_large_hub_is_never_listed(spark):
    """1,000 sources and 1,000 targets of one value, ten concepts: a million links, at most a hundred rows."""
    n = spark.range(2_000)
    source = F.col("id") < 1_000
    nodes = n.select(
        "id",
        F.array(F.when(source, "Src_A").otherwise("Src_B")).alias("labels"),
        F.expr("map('k', named_struct('dtype', 'String', 'is_list', false, 'vals', array('all')))").alias("props"),
    )
    edges = n.select(
        F.col("id").alias("src"),
        F.array(F.when(source, "Src_A").otherwise("Src_B")).alias("src_labels"),
        (F.col("id") % 10 + 5_000).alias("dst"),
        F.array(F.lit("CONCEPT")).alias("dst_labels"),
        F.lit("MAPPED_TO").alias("rel"),
        F.expr("cast(map() as map<string,struct<dtype:string,is_list:boolean,vals:array<string>>>)").alias("props"),
    )
    lifted = factored.lifted_links(Graph.of(nodes, edges), LINK)
    rows = lifted.collect()
    assert len(rows) == 90 and {row.n for row in rows} == {10_000}
    result = combine.combine_edges(Graph.of(nodes.limit(0)), lifted)
    assert result.edges.count() == 90 and result.edge_values.count() == 90 * 7


def test_no_shared_value(spark):
    given = graph(spark, [(1, ["Src_A"], {"k": "x"}), (2, ["Src_B"], {"k": "y"}), (3, ["Src_B"], {})])
    assert factored.lifted_links(given, LINK).collect() == []
