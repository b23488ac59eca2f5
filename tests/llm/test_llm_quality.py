import random
import zlib

import numpy as np
import pytest

from kinfold.llm import quality


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    docs, labels = [], []
    for i in range(600):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(20, 120))) + "."
        good = rng.random() < 0.7
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", " | "), " ".join([words[i % 500]] * 60)])
        docs.append((i, text, "x"))
        if i % 2:
            labels.append((i, int(good), None))
    return spark.createDataFrame(docs, "doc_id bigint, text string, score string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    rows = quality.score(docs, labels).join(labels, "doc_id").collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in rows)
    held = [row for row in rows if row.held_out]
    assert np.mean([row.predicted == row.quality for row in held]) > 0.9


def test_held_out_labels_are_not_read(corpus, spark):
    docs, labels = corpus
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(quality.remainder(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {row.doc_id: row.score for row in quality.score(docs, labels).collect()}
    second = {row.doc_id: row.score for row in quality.score(docs, turned).collect()}
    assert first == pytest.approx(second)


def test_isotonic_equals_pooling_by_hand():
    places, shares = quality.isotonic(np.arange(5.0), np.array([1, 1, 0, 2, 1.0]), np.array([1, 0, 0, 1, 1.0]))
    assert shares.tolist() == [0.5, 1.0] and places[0] == pytest.approx((0 + 1 + 3 + 3) / 4)


def test_no_labels_and_one_kind_of_label(messy, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (5, 1), (7, 1), (6, None), (None, 0)], "doc_id bigint, quality int")
    assert {row.score for row in quality.score(messy, labels.filter("doc_id < 0")).collect()} == {0.5}
    rows = quality.score(messy, labels).collect()
    assert len(rows) == messy.count() and all(row.held_out is not None for row in rows)
    assert quality.score(no_docs, labels).collect() == []
    kept = quality.keep_good(messy, labels)
    assert kept.columns == messy.columns and kept.count() <= messy.count()
    assert quality.keep_good(no_docs, labels).collect() == []


def test_statistics_have_one_size():
    for text in ("", " ", "\n\n", "a", "é🙂", "1 2 3", "x" * 100_000):
        values = quality.statistics(text)
        assert len(values) == quality.N_STATISTICS and np.isfinite(values).all()


@pytest.mark.parametrize("tasks", [1, 5])
def test_fit_equals_one_ridge_over_all_rows(spark, tasks):
    rng = np.random.default_rng(3)
    table = rng.normal(size=(300, quality.N_STATISTICS)).astype(np.float32)
    marks = (table[:, 0] + table[:, 1] ** 2 > 0.7).astype(int)
    measured = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(table)], "doc_id bigint, statistics array<float>").repartition(tasks)
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(marks)], "doc_id bigint, quality int")
    scorer = quality.fit(measured, labels)
    used = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i in range(300)])
    rows, y = table[used].astype(float), marks[used]
    assert scorer.mean == pytest.approx(rows.mean(0)) and scorer.scale == pytest.approx(rows.std(0))
    waves = np.sqrt(2 / quality.WAVES) * np.cos(np.clip((rows - rows.mean(0)) / rows.std(0), -8, 8) @ scorer.frequencies + scorer.phases)
    design = np.vstack([np.hstack([waves, np.ones((len(rows), 1))]), np.sqrt(np.append(np.full(quality.WAVES, quality.RIDGE), 1e-9)) * np.eye(quality.WAVES + 1)])
    want = np.linalg.lstsq(design, np.append(y, np.zeros(quality.WAVES + 1)), rcond=None)[0]
    assert scorer.weights == pytest.approx(want, abs=1e-6)
