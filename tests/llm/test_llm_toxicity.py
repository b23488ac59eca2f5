import random
import zlib

import numpy as np
import pytest

from kinfold.llm import toxicity

INSULTS = ["grubbel", "snarfo", "plonkt"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijkmno") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(700):
        text = [rng.choice(words) for _ in range(rng.randint(5, 150))]
        toxic = rng.random() < 0.2
        if toxic:  # stems with any ending, anywhere in the text
            text.insert(rng.randint(0, len(text)), rng.choice(INSULTS).upper() + rng.choice(words))
        docs.append((i, " ".join(text), "x"))
        if i % 3:
            labels.append((i, None, int(toxic)))
    docs.append((9_000, " ".join(rng.choice(words) for _ in range(30_000)) + " snarfox", "x"))
    return spark.createDataFrame(docs, "doc_id bigint, text string, score string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy_and_whole_texts(corpus):
    docs, labels = corpus
    rows = {row.doc_id: row for row in toxicity.score(docs, labels).collect()}
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in rows.values())
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in rows.values())
    held = [(rows[label.doc_id], label.toxic) for label in labels.collect() if rows[label.doc_id].held_out]
    assert np.mean([row.predicted == toxic for row, toxic in held]) > 0.95
    toxic = [row.score for row, label in held if label]
    clean = [row.score for row, label in held if not label]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.97
    assert rows[9_000].score > np.median(clean)  # one word at the end of a very long text


def test_held_out_labels_are_not_read(corpus):
    from pyspark.sql import functions as F

    docs, labels = corpus
    held = F.coalesce(toxicity.remainder(F.col("doc_id")) == 2, F.lit(False))
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = ({row.doc_id: row.score for row in toxicity.score(docs, given).collect()} for given in (labels, turned))
    assert first == pytest.approx(second)


def by_hand(text):
    text = " " + " ".join(text.lower().split()) + " "
    return {text[at : at + n] for n in toxicity.ORDERS for at in range(len(text) - n + 1)}


def test_counts_and_ratios_equal_a_plain_count(spark):
    rows = [(1, "Ab c d", 1), (2, "ab  C", 0), (3, "", 0), (3, "", 0), (4, "zzzzzz zzzzzz é🙂", 1)]
    counted = {row.bucket: (row.toxic, row.clean) for row in toxicity.counts(spark.createDataFrame(rows, "id int, text string, y int")).collect()}
    assert counted.pop(1 << toxicity.BITS) == (2, 3)
    want = {}
    for _, text, y in rows:
        for gram in by_hand(text):
            bucket = gram
            toxic, clean = want.get(bucket, (0, 0))
            want[bucket] = (toxic + y, clean + 1 - y)
    assert sorted(counted.values()) == sorted(want.values())  # no two of these n-grams share a bucket
    buckets, ratio = toxicity.ratios(toxicity.counts(spark.createDataFrame(rows, "id int, text string, y int")), 2, 3)
    expected = sorted(np.log((toxic + 1) / 4) - np.log((clean + 1) / 5) for toxic, clean in want.values())
    assert len(buckets) == len(set(buckets)) and sorted(ratio) == pytest.approx(expected)


def test_long_and_short_texts_give_the_same_buckets():
    rng = random.Random(1)
    text = "".join(rng.choice("abcde fghij") for _ in range(30_000))
    parts = [toxicity.grams(text[at : at + 2_000]) for at in range(0, len(text), 1_000)]
    whole = toxicity.grams(text)
    assert (np.diff(whole.astype(np.int64)) > 0).all()
    assert len(set(whole.tolist()) - set(np.concatenate(parts).tolist())) < 60  # the pieces differ from the whole at their ends
    assert toxicity.grams("").tolist() == toxicity.grams(" \n").tolist() and len(toxicity.grams("\ud800a"))


def test_weights_lie_where_the_loss_is_least():
    rng = np.random.default_rng(3)
    n, d = 200, 6
    held = rng.random((n, d)) < 0.4
    y = (rng.random(n) < 1 / (1 + np.exp(-(held @ rng.normal(0, 2, d) - 0.5)))).astype(float)
    scale, weight = rng.uniform(0.5, 3, d), rng.uniform(0.5, 2, n)
    places, starts = np.nonzero(held)[1], np.concatenate([[0], np.cumsum(held.sum(1))])
    learned, intercept = toxicity.logistic(places, starts, y, weight, scale)
    x = held * scale
    off = weight * (1 / (1 + np.exp(-(x @ learned + intercept))) - y)
    assert np.abs(x.T @ off + toxicity.PENALTY * learned).max() < 0.05 and abs(off.sum()) < 0.05


def test_no_labels_one_kind_and_messy_rows(messy, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (7, 1), (6, None), (None, 0), (8, 0)], "doc_id bigint, toxic int")
    assert {row.score for row in toxicity.score(messy, labels.filter("doc_id < 0")).collect()} == {0.5}
    only = labels.filter("doc_id = 7")
    n = sum(zlib.crc32(b"7") % 4 != 2 for _ in range(1))
    assert {round(row.score, 6) for row in toxicity.score(messy, only).collect()} == {round((n + 1) / (n + 2), 6) if n else 0.5}
    rows = toxicity.score(messy, labels).collect()
    assert len(rows) == messy.count() and all(row.held_out is not None and 0 <= row.score <= 1 for row in rows)
    assert len({row.score for row in rows if row.doc_id in (2, 3, 4)}) == 1  # null, empty and blank
    assert toxicity.score(no_docs, labels).collect() == []
