import json
import random

import pytest
from graphs import graph, node_values, rows
from pyspark.sql import functions as F

from kinfold.operators import discover, routing
from kinfold.sources import files

SCORE = "label string, key string, score int, confidence double, reasoning string"
RESEARCH = "label string, key string, research_score int, research_reasoning string"
VERDICT = "label string, key string, justified boolean, revised int, correction string"


def routed(spark, scores, research=(), verdicts=(), sanity=False):
    done = routing.route_scores(
        spark.createDataFrame(scores, SCORE),
        spark.createDataFrame(list(research), RESEARCH),
        routing.checked_verdicts(spark.createDataFrame(list(verdicts), VERDICT)),
        sanity=F.lit(sanity),
    )
    return {row.key: row for row in done.collect()}


def test_routing_example(spark):
    done = routed(
        spark,
        [("User", "email", 9, 95.0, "Essential"), ("User", "age", 5, 40.0, "Unsure")],
        [("User", "age", 6, "Actually secondary attribute"), ("User", "email", 1, "not asked")],
        [("User", "age", True, None, "Good")],
    )
    email, age = done["email"], done["age"]
    assert (email.final_score, email.final_rationale, email.judged, email.escalated) == (9, "Essential", False, False)
    assert email.research_score is None
    assert (age.final_score, age.final_rationale, age.judged) == (6, "Actually secondary attribute", True)


def test_grey_zone_and_verdicts(spark):
    scores = [("L", str(s), s, 90.0, "r") for s in (2, 3, 6, 7)]
    done = routed(spark, scores, (), [("L", "3", False, None, "why"), ("L", "6", False, 2, "internal"), ("L", "7", False, 1, "x")])
    assert {key for key, row in done.items() if row.judged} == {"3", "6"}
    assert (done["3"].final_score, done["3"].final_rationale) == (3, "r | Corrected by Judge: why")
    assert (done["6"].final_score, done["7"].final_score) == (2, 7)
    assert all(row.judged for row in routed(spark, scores, sanity=True).values())


def test_partial_research_and_unusable_verdict(spark):
    done = routed(
        spark,
        [("L", "a", 9, 10.0, "r"), ("L", "b", 4, 90.0, "r")],
        [("L", "a", None, "better reason")],
        [("L", "b", False, 11, "too high")],
    )
    assert (done["a"].final_score, done["a"].final_rationale) == (9, "better reason")
    assert (done["b"].justified, done["b"].final_score) == (True, 4)


def test_score_checks(spark):
    scores = spark.createDataFrame(
        [("L", "a", 11, 1.0, "r"), ("L", "b", 1, None, "r"), ("L", "c", 0, 100.0, "r"), ("L", "d", 1, 1.0, None)], SCORE
    )
    done = {r.key: r for r in routing.checked_scores(scores).collect()}
    assert [done[k].faulty for k in "abcd"] == [True, True, False, True]
    assert (done["a"].score, done["a"].confidence, done["c"].score) == (5, 50.0, 0)


def test_sample_is_repeatable(spark):
    keys = spark.range(4000).select(F.lit("L").alias("label"), F.col("id").cast("string").alias("key"))
    picked = keys.filter(routing.sampled(0.1))
    assert 300 < picked.count() < 500 and rows(picked) == rows(keys.repartition(7).filter(routing.sampled(0.1)))


def test_export(spark, tmp_path):
    audited = spark.createDataFrame(
        [("A", "x", 3, "why"), ("A", "y", 4, "so")], "label string, key string, final_score int, final_rationale string"
    )
    files.write_scores(audited, str(tmp_path / "scores"))
    found = spark.read.json(str(tmp_path / "scores")).select("label", "key", "importance_score", "rationale").collect()
    assert sorted(map(tuple, found)) == [("A", "x", 3, "why"), ("A", "y", 4, "so")]


def test_strip_texts(spark):
    g = graph(
        spark,
        [(1, ["GeneOntology_Term"], {"xrefs": ["EC:1", "skos:exactMatch GO:2"], "id": "GO:3"}), (2, ["Other"], {"xrefs": ["EC:1"]})],
    )
    done = g.with_(nodes=discover.strip_texts(g.nodes))
    assert node_values(done) == {(1, "xrefs"): ["1", "2"], (1, "id"): "GO:3", (2, "xrefs"): ["EC:1"]}


def test_overlap(spark):
    g = graph(
        spark,
        [(i, ["A"], {"x": f"v{i}", "y": f"w{i}"}) for i in range(10)]
        + [(20 + i, ["B"], {"z": [f"v{i}", f"v{i}"]}) for i in range(5)],
    )
    found = discover.property_overlap(g).collect()
    assert [(r.key_1, r.key_2, r.shared, r.containment, r.jaccard, r.confidence, r.evidence) for r in found] == [
        ("x", "z", 5, 1.0, 0.5, 10, "v0")
    ]


def test_flatten(spark):
    g = graph(spark, [(1, ["A"], {"names": ["a", "b", "c"], "id": "k"}), (2, ["A"], {"names": ["d"]})])
    assert rows(discover.flatten_lists(g.nodes)) == [
        (1, "names_0", "a"), (1, "names_1", "b"), (1, "names_str", "a, b, c"), (2, "names_0", "d"), (2, "names_str", "d"),
    ]


def test_label_rules(spark):
    mapping = spark.createDataFrame([("A_x", "X"), ("B_x", "X"), ("C", "UNCLASSIFIED")], "label string, concept string")
    assert rows(discover.concept_labels(mapping)) == [("X", "A_x"), ("X", "B_x")]
    labels = spark.createDataFrame([("A_x",), ("B_y_x",), ("C",)], "label string")
    assert rows(discover.label_suffixes(labels)) == [("x", "A_x"), ("x", "B_y_x")]
    classified = discover.classify(labels, spark.createDataFrame([("X", "A_x")], "concept string, label string"))
    assert {r.label: r.concept for r in classified.collect()} == {"A_x": "X", "B_y_x": None, "C": None}
    choices = spark.createDataFrame([("A", "x"), ("A", "q"), ("Z", "q")], "label string, property string")
    schema = spark.createDataFrame([("A", "x")], "label string, key string")
    flagged = {(r.label, r.property): r.error for r in discover.mapping_checks(choices, schema).collect()}
    assert flagged["A", "x"] is None and "'q'" in flagged["A", "q"] and flagged["Z", "q"] is None
    candidates = spark.createDataFrame([("X",), ("Y",)], "concept string")
    decisions = spark.createDataFrame([("X", True, "fits"), ("Y", False, "no")], "concept string, kept boolean, reason string")
    kept, removed = discover.split_by_decision(candidates, decisions)
    assert rows(kept) == [("X", "fits")] and rows(removed) == [("Y", "no")]


# --- files ------------------------------------------------------------------


def test_merged_ids(spark, tmp_path):
    path = tmp_path / "merged.txt"
    path.write_text("12\t|\t74109\t|\n\nx\n | 5 |\n30 | 1 |\n30 | 2 |\n")
    assert rows(files.read_merged_ids(spark, str(path))) == [(12, 74109), (30, 2)]


def test_id_config(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text("GTDB_Genome; ncbi_taxid; 1313\nTAXON; ids; [NCBITaxon:1785091]\n\nU; refs; [NCBI Taxonomy:48017]\n")
    found = [(c.label, c.property, c.is_list, c.prefix) for c in files.read_id_config(spark, str(path))]
    assert found == [
        ("GTDB_Genome", "ncbi_taxid", False, ""), ("TAXON", "ids", True, "NCBITaxon:"), ("U", "refs", True, "NCBI Taxonomy:"),
    ]


def test_catalogue_files(spark, tmp_path):
    def write(name, content):
        (tmp_path / name).write_text(json.dumps(content))
        return str(tmp_path / name)

    groups = write("groups.json", {"Gene": [{"nodelabel": "G_a", "attribute": "id"}, {"nodelabel": "G_b", "attribute": "name"}]})
    (blueprint,) = files.read_identity_groups(spark, groups)
    assert blueprint.concept == "Gene" and list(blueprint.fields.values()) == [("G_a", "id"), ("G_b", "name")]
    nested = write("nested.json", {"GENE": {"HGNC": ["id", "symbol"]}, "X": {"CONST": "Label"}})
    assert rows(files.read_nested_catalogue(spark, nested, "concept", "source")) == [
        ("GENE", "HGNC", "id"), ("GENE", "HGNC", "symbol"), ("X", "CONST", "Label"),
    ]
    examples = write("examples.json", {"GENE": {"explanation": "e", "examples": ["A", "B"]}})
    assert rows(files.read_examples(spark, examples)) == [("GENE", "A"), ("GENE", "B")]
    assert rows(files.read_names(spark, write("a.json", ["x", "y"]))) == [("x",), ("y",)]
    assert rows(files.read_names(spark, write("b.json", {"z": "failed"}))) == [("z",)]
    (tmp_path / "o.tsv").write_text("Source Label\tP\tT\tQ\tC\tE\tR\nA\tid\tB\tid\t10\tsame\tboth\n")
    assert files.read_overlaps(spark, str(tmp_path / "o.tsv")).first().confidence == 10


def overlapping(spark, seed):
    """Properties of 5 to 600 values out of ranges that overlap by any share."""
    rng = random.Random(seed)
    values = []
    for prop in range(14):
        low, n = rng.randint(0, 800), rng.choice([5, 20, 60, 200, 600])
        values += [(("L" + str(prop % 3), f"k{prop}"), f"v{rng.randint(low, low + 2 * n)}") for _ in range(n)]
    return spark.createDataFrame(values, "prop struct<label:string,key:string>, val string")


@pytest.mark.parametrize("seed, limit", [(1, 0.2), (2, 0.5)])
def test_sketches_pass_over_no_pair(spark, seed, limit):
    values = overlapping(spark, seed)
    held = {}
    for row in values.collect():
        held.setdefault(tuple(row.prop), set()).add(row.val)
    want = {(a, b) for a in held for b in held if a < b and len(held[a] & held[b]) >= max(1, limit * min(len(held[a]), len(held[b])))}
    for size in (32, 256):
        found = set(discover.candidate_pairs(discover.property_sketches(values, size), limit, size))
        assert want <= found
    assert len(found) < 14 * 13 / 2  # the larger sketches do rule pairs out


def test_sketches_merge(spark):
    values = overlapping(spark, 3)
    one, two = values.filter("xxhash64(val) % 2 = 0"), values.filter("xxhash64(val) % 2 <> 0 or hash(val) % 3 = 0")
    merged = discover.merge_sketches(discover.property_sketches(one, 50), discover.property_sketches(two, 50), size=50)
    assert rows(merged) == rows(discover.property_sketches(values, 50))


def test_likely_overlap(spark):
    nodes = [(i, ["A" if i % 2 else "B"], {"k": f"v{i // 4}", "m": [f"v{i}", "w"], "own": f"{i % 2}-{i}"}) for i in range(400)]
    g = graph(spark, nodes)
    want = rows(discover.property_overlap(g).filter("containment >= 0.6"))
    assert rows(discover.likely_overlap(g, 0.6)) == want and want
    assert rows(discover.likely_overlap(graph(spark, [(1, ["A"], {})]), 0.6)) == []
