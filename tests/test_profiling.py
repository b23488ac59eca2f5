from graphs import graph, rows
from pyspark.sql import types as T

from kinfold.operators import profile, propagate, scan

M = "MAPPED_TO"


def mixed(spark):
    return graph(
        spark,
        [
            (1, ["A"], {"n": 1, "l": ["a", "b", "c", "d", "e", "f"], "odd": 1}),
            (2, ["A"], {"n": 2, "l": ["x"], "odd": "one", "flag": True}),
            (3, ["Src_b"], {"n": 1.5}),
            (4, ["NONE"]),
        ],
        [(1, "R", 2, {"w": 1}), (2, "R", 1), (3, M, 1)],
    )


def test_types(spark):
    g = mixed(spark)
    assert rows(profile.node_property_types(g)) == [
        ("A", "flag", "Boolean", ["Boolean"]),
        ("A", "l", "StringArray", ["StringArray"]),
        ("A", "n", "Long", ["Long"]),
        ("A", "odd", "Long", ["Long", "String"]),
        ("Src_b", "n", "Double", ["Double"]),
    ]
    assert ("A", "odd", "Any") in rows(profile.catalogue(g))
    assert rows(profile.schema_edges(g)) == [("A", "R", "A"), ("Src_b", M, "A")]
    assert rows(profile.property_usage(g).select("key", "label", "type"))[2:4] == [
        ("n", "A", "Double"), ("n", "Src_b", "Double"),
    ]
    assert rows(profile.schema_counts(g)) == [
        ("edge_properties", 1), ("labels", 3), ("node_properties", 5), ("property_keys", 4), ("relations", 2), ("schema_edges", 2),
    ]


def test_profile(spark):
    g = mixed(spark)
    found = {(r.label, r.key, r.n): r["sample"] for r in profile.property_profile(g, concept_only=True).collect()}
    assert found["A", "l", 1] == "['a', 'b', 'c', 'd', 'e', ...]" and found["A", "l", 2] == "['x']"
    assert found["A", "odd", 2] == "one" and not any(label == "Src_b" for label, _, _ in found)
    keys = spark.createDataFrame([("n",)], "key string")
    assert {r.key for r in profile.property_profile(g, keys=keys).collect()} == {"n"}
    assert rows(profile.sample_types(g)) == [
        ("A", "flag", "Boolean"), ("A", "l", "List"), ("A", "n", "Integer"), ("A", "odd", "Integer"), ("Src_b", "n", "Float"),
    ]


def test_profile_of_merged_values(spark):
    nodes = [(i, ["S_a"], {"v": i}) for i in range(1, 8)] + [(20, ["ONE"]), (21, ["ONE"])]
    g = propagate.property_roll_up(graph(spark, nodes, [(i, M, 20) for i in range(1, 8)] + [(1, M, 21)]))
    found = rows(profile.property_profile(g, concept_only=True))
    assert found == [
        ("ONE", "S_a__v", "LongArray", 1, "[1, 2, 3, 4, 5, ...]"), ("ONE", "S_a__v", "LongArray", 2, "[1]"),
    ]


def test_connections(spark):
    found = rows(profile.local_connections(mixed(spark)))
    assert ("A", "in", f"(:`Src_b`)-[:`{M}`]->(:`A`)") in found and ("A", "out", "(:`A`)-[:`R`]->(:`A`)") in found
    nodes = [(0, ["HUB"])] + [(i, [f"T{i:02d}"]) for i in range(1, 41)]
    wide = graph(spark, nodes, [(0, "R", i) for i in range(1, 41)])
    limited = profile.local_connections(wide).filter("label = 'HUB'")
    assert limited.count() == 30
    metadata = {(r.label, r.key): r for r in profile.property_metadata(mixed(spark)).collect()}
    assert metadata["A", "n"].samples == ["1", "2"] and len(metadata["A", "n"].connections) == 3


def test_unmapped(spark):
    assert rows(profile.unmapped_labels(mixed(spark))) == [(["A"],), (["NONE"],)]


def test_wide_view(spark):
    wide = profile.wide_view(mixed(spark), "A")
    assert wide.schema["n"].dataType == T.LongType() and wide.schema["odd"].dataType == T.ArrayType(T.StringType())
    assert wide.filter("flag").select("id", "n", "l").collect() == [(2, 2, ["x"])]


def test_scan(spark):
    g = mixed(spark)
    assert rows(scan.find(g.nodes, "A", n=2, flag=True).select("id")) == [(2,)]
    assert scan.find(g.nodes, "A").count() == 2
    assert rows(scan.samples(g.nodes, "A", 1).select("id")) == [(1,)]
    assert rows(scan.property_examples(g.nodes, "A", "odd")) == [("1",), ("one",)]
    assert rows(scan.values_of(g, "A", "l"))[-1] == (2, "x")
    ids = spark.createDataFrame([(1,), (4,), (4,), (77,)], "id bigint")
    assert rows(scan.properties_of(g.nodes, ids).select("id", "label")) == [(1, "A"), (4, "NONE")]
    limited = scan.property_samples(g.nodes, 1).filter("label = 'A'")
    assert {r.key: r.id for r in limited.collect()} == {"n": 1, "l": 1, "odd": 1, "flag": 2}
    table = spark.createDataFrame([(7, "a", None), (8, None, None)], "k int, x string, y string")
    saved = scan.save_record(table, "NEW", table.k, x=table.x, y=table.y)
    assert [(r.id, r.labels, sorted(r.props)) for r in saved.orderBy("id").collect()] == [(7, ["NEW"], ["x"]), (8, ["NEW"], [])]


def test_pending(spark):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "name string")

    assert rows(scan.pending(names("a", "b", "c", "d"), names("a"), names("d", "x"))) == [("b",), ("c",)]
