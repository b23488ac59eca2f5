from pyspark.sql import functions as F

import pytest
from kinfold.functions import answers, names, values


def one(spark, rows, schema, column):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [row["x"] for row in frame.select("i", column.alias("x")).orderBy("i").collect()]


def test_placeholders(spark):
    rows = [(" N/A ",), ("None",), ("",), (None,), ("0",), ("\tUNKNOWN\n",), ("na x",), ("\xa0null　",)]
    assert one(spark, rows, "v string", values.is_valid(F.col("v"))) == [
        False, False, False, False, True, False, True, False,
    ]


def test_trailing_digits(spark):
    rows = [("NCBI Taxonomy:48017",), ("abc",), ("1313",), ("12a",), (None,)]
    assert one(spark, rows, "v string", values.trailing_digits(F.col("v"))) == [48017, None, 1313, None, None]


def test_format_like(spark):
    rows = [("12", "Long", "NCBITaxon:"), ("12", "String", "NCBITaxon:"), ("NCBITaxon:12", "String", "NCBITaxon:")]
    shaped = values.format_like(F.col("v"), F.col("d"), F.lit(5), F.col("p"))
    assert one(spark, rows, "v string, d string, p string", shaped) == ["5", "5", "NCBITaxon:5"]


def test_pubmed(spark):
    rows = [("123.0",), ("77",), ("",)]
    assert one(spark, rows, "v string", values.pubmed_curie(F.col("v"))) == ["PMID:123", "PMID:77", ""]


def test_label_case(spark):
    rows = [(["X_y"],), (["X"],), (["X_y", "X"],), ([],), (["X1"],)]
    assert one(spark, rows, "l array<string>", values.is_source_node(F.col("l"))) == [True, False, False, True, False]
    rows = [("TAXON",), ("Taxon",), ("123",)]
    assert one(spark, rows, "v string", values.is_upper_label(F.col("v"))) == [True, False, False]


def test_json_shapes(spark):
    rows = [
        ('{"a": 1}',),
        ('```json\n{"a": 2}\n```',),
        ('random text {"a": 3} extra text',),
        ('```\n{bad}\n``` then {"a": 4}',),
        ("no json",),
        ("[1, 2]",),
        (None,),
        ("} {",),
    ]
    found = one(spark, rows, "v string", answers.extract_json(F.col("v")))
    # The braces of the fourth text span both objects, so nothing in it is JSON.
    assert found == ['{"a": 1}', '{"a": 2}', '{"a": 3}', None, None, "[1, 2]", None, None]


def test_final_answer_and_tool(spark):
    rows = [
        ('Thought\nFinal Answer: {"importance_score": 9} bye',),
        ("Action: web_search(\"what 'is' it\")",),
        ("nothing",),
    ]
    text = F.col("v")
    assert one(spark, rows, "v string", answers.final_answer(text)) == ['{"importance_score": 9}', None, None]
    assert one(spark, rows, "v string", answers.tool_name(text)) == [None, "web_search", None]
    assert one(spark, rows, "v string", answers.tool_argument(text)) == [None, "what 'is' it", None]


def test_names(spark):
    assert names.quote("a`b") == "`a``b`"
    given = ["1 a-b", "class", "", "Id", "id", "i.d", "ID", "id_1", "id_1_1"]
    found = names.column_names(spark.createDataFrame([("L", key) for key in given], "label string, key string")).collect()
    columns = {row.key: row.column for row in found}
    assert len(set(columns.values())) == len(given)
    expected = {"1 a-b": "node_1_a_b", "class": "class_", "": "node_", "ID": "id", "id": "id_2", "i.d": "i_d", "id_1": "id_1"}
    assert {key: columns[key] for key in expected} == expected and columns["Id"].startswith("id_1_")


def test_bad_property_name(spark):
    from graphs import graph
    from kinfold.operators.scan import property_examples

    with pytest.raises(ValueError):
        property_examples(graph(spark, [(1, ["A"], {"x": 1})]).nodes, "A", "a`b")
