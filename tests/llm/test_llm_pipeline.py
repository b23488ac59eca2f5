import os

import pytest

pytest.importorskip("public_tokenizers")

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from kinfold.llm import packing, queries  # noqa: E402
from test_llm_secrets import base  # noqa: E402
from test_llm_simhash import components, slow_fingerprint  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not there")


def test_all_operators_are_registered():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@needs_tables
def test_stages_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    planted = "In this, onorer heshha and thinerble anhaan, password=b7db7aa4a5fcc78305 edes reating thly ou ed of the thonound. " * 3
    kept = [docs.unionByName(spark.createDataFrame([(10**6, planted, "en", "src0", len(planted))], docs.schema))]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF_DIR).write.parquet(f"{tmp_path}/{number}")
        kept.append(spark.read.parquet(f"{tmp_path}/{number}"))
    _, good, single, masked, packed = kept
    assert good.columns == single.columns == masked.columns == columns
    labels = {row.doc_id: row.quality for row in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    stayed = {row.doc_id for row in good.collect()}
    assert sum(i in stayed for i, q in labels.items() if q) / sum(q for q in labels.values()) > 0.95
    # Near duplicates against all pairs.
    rows = sorted(good.collect(), key=lambda row: row.doc_id)
    groups = {}
    for row, root in zip(rows, components([slow_fingerprint(row.text) for row in rows])):
        groups.setdefault(root, []).append(row.doc_id)
    assert sorted(row.doc_id for row in single.collect()) == sorted(map(min, groups.values()))
    # Secrets: no rule finds one any more, and clean texts are as they were.
    before = {row.doc_id: row.text for row in single.collect()}
    after = {row.doc_id: row.text for row in masked.collect()}
    assert before.keys() == after.keys() and not any(base(text) for text in after.values())
    assert all(after[i] == text for i, text in before.items() if not base(text))
    assert any(base(text) for text in before.values())
    # Packing: all ids of all texts, once.
    encode = packing.encoder(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).encode
    assert {row.doc_id: row.n for row in packed.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()} == {
        i: len(encode(text)) + 1 for i, text in after.items()
    }
    ran = corpus_pipeline.run(spark, SF_DIR)
    packed = packed.filter(f"doc_id <> {10**6}")
    assert sorted((row.doc_id, row.doc_tokens) for row in ran.select("doc_id", "doc_tokens").distinct().collect()) == sorted(
        (row.doc_id, row.doc_tokens) for row in packed.select("doc_id", "doc_tokens").distinct().collect()
    )


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    import duckdb

    from tools.check_oracle import canonical

    con = duckdb.connect()
    for table in ("pages", "embeddings", "documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    assert canonical(queries.QUERIES[name](spark, SF_DIR).toPandas()) == canonical(con.sql(queries.ORACLES[name]).df())
