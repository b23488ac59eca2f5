"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios (operator 12)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.batches import in_arrow, per_text
from kinfold.llm.components import settled

ORDERS = (3, 4, 5)  # lengths of the n-grams, in characters
BITS = 18  # of an n-gram's bucket
FEATURES = 1_024  # buckets whose ratio is the surest, which the classifier sees
SAMPLE = 4_000  # labelled rows of each kind that fit the weights, those of smallest hash; counts and ratios are over all rows
SMOOTH = 1.0  # added to each count
PENALTY = 1.0
STEPS = 60
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
UNKNOWN = 0.5  # the score where there are no labels at all


def grams(text: str) -> np.ndarray:
    """The different buckets of the n-grams of the whole text, lower case, white space as one blank, a blank at both ends."""
    codes = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    found = []
    for n in ORDERS:
        if len(codes) < n:
            continue
        key = np.full(len(codes) - n + 1, n, np.uint32)
        for at in range(n):
            key = key * np.uint32(0x01000193) ^ codes[at : at + len(key)] * np.uint32(0x9E3779B1)
        found.append((key * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
    if not found:
        return np.zeros(0, np.uint32)
    keys = np.concatenate(found)
    if len(keys) > 1 << BITS - 4:  # a long text: a mark for each bucket is cheaper than sorting
        marks = np.zeros(1 << BITS, bool)
        marks[keys] = True
        return np.flatnonzero(marks).astype(np.uint32)
    return np.unique(keys)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text modulo ``FOLDS``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


@dataclass(frozen=True)
class Classifier:
    """A weight per bucket (0 for those not chosen) and the intercept; what scoring takes, whatever the corpus."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        raw = self.intercept + float(self.weights[grams(text)].sum()) if len(self.weights) else self.intercept
        return float(1 / (1 + np.exp(-np.clip(raw, -500, 500))))


def training_labels(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``id`` and ``y`` of the labelled documents that are not held out.

    A document with several labels has the one of most rows, 1 where they are
    even; null labels and ids are passed over.
    """
    wanted = labels.filter(F.col(label).isNotNull() & (remainder(F.col(doc_id)) != HELD_OUT))
    return wanted.groupBy(F.col(doc_id).alias("id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))


def labelled(docs: DataFrame, wanted: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``id``, ``text``, ``y`` of the rows of ``docs`` in ``wanted``; the texts are shuffled once, by id, at every size."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.join(wanted.hint("shuffle_hash"), "id")


def counts(rows: DataFrame) -> DataFrame:
    """``bucket``, ``toxic`` and ``clean``: the training rows of each kind that hold an n-gram of the bucket.

    Each task counts its own rows in two arrays of fixed size and gives the
    buckets it met. The bucket 2^``BITS`` counts all rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, (1 << BITS) + 1), np.int64)
        for batch in batches:
            for value, y in zip(batch.column("text"), batch.column("y")):
                held[y.as_py(), grams(value.as_py())] += 1
                held[y.as_py(), -1] += 1
        met = np.flatnonzero(held.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(held[1, met]), pa.array(held[0, met])], names=["bucket", "toxic", "clean"])

    met = in_arrow(rows.select("text", "y"), run, "bucket bigint, toxic bigint, clean bigint")
    return met.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def ratios(counted: DataFrame, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and log-count ratios of the ``FEATURES`` n-grams whose ratio is the most standard errors away from 0."""
    p, q = F.col("toxic") + SMOOTH, F.col("clean") + SMOOTH
    ratio = F.log(p / (toxic + 2 * SMOOTH)) - F.log(q / (clean + 2 * SMOOTH))
    rated = counted.filter(F.col("bucket") < 1 << BITS).select("bucket", ratio.alias("ratio"), (F.abs(ratio) / F.sqrt(1 / p + 1 / q)).alias("sure"))
    chosen = rated.orderBy(F.desc("sure"), "bucket").limit(FEATURES).toPandas().sort_values("bucket")
    return chosen.bucket.to_numpy(np.int64), chosen.ratio.to_numpy(float)


def _sample(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the chosen features of the sampled rows, one after another, where each row starts, and the labels.

    The sample is drawn from ids and labels alone; its at most 2 x ``SAMPLE`` ids are broadcast to the texts.
    """
    held = docs.select(F.col(doc_id).alias("id")).distinct().join(wanted, "id")
    kinds = [held.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for y in (0, 1)]
    drawn = settled(kinds[0].unionByName(kinds[1]))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    place = np.full(1 << BITS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, y in zip(batch.column("text"), batch.column("y")):
                found = place[grams(value.as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([found[found >= 0].astype(np.uint16).tobytes()], pa.binary()), pa.array([y.as_py()], pa.int32())], names=["places", "y"]
                )

    chosen = rows.join(F.broadcast(drawn), "id").select("text", "y")
    found = in_arrow(chosen, run, "places binary, y int").collect()
    found.sort(key=lambda row: (row.y, bytes(row.places)))  # the same order, and so the same sums, in every run
    parts = [np.frombuffer(bytes(row.places), np.uint16) for row in found]
    starts = np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int64)
    return np.concatenate([*parts, np.zeros(0, np.uint16)]), starts, np.array([row.y for row in found], float)


def logistic(places: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with a quadratic penalty, by limited-memory quasi-Newton steps.

    Row i has the value ``scale[j]`` in each feature j of ``places[starts[i]:starts[i + 1]]``.
    """
    owner = np.repeat(np.arange(len(y)), np.diff(starts))

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        raw = np.bincount(owner, (v[:-1] * scale)[places], len(y)) + v[-1]
        off = weight * (1 / (1 + np.exp(-np.clip(raw, -500, 500))) - y)
        slope = np.append(np.bincount(places, off[owner], len(scale)) * scale + PENALTY * v[:-1], off.sum())
        return float((weight * (np.logaddexp(0, raw) - y * raw)).sum() + PENALTY / 2 * (v[:-1] ** 2).sum()), slope

    share = (weight * y).sum() / weight.sum()
    v = np.append(np.zeros(len(scale)), np.log(share / (1 - share)))
    value, slope = loss(v)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        way, kept = -slope, []
        for s, g, rho in reversed(steps):
            kept.append(rho * (s @ way))
            way = way - kept[-1] * g
        if steps:
            s, g, _rho = steps[-1]
            way = way * (s @ g) / (g @ g)
        else:
            way = way / max(np.linalg.norm(slope), 1)
        for (s, g, rho), a in zip(steps, reversed(kept)):
            way = way + (a - rho * (g @ way)) * s
        size = 1.0
        while size > 1e-9:
            after, turned = loss(v + size * way)
            if after <= value + 1e-4 * size * (slope @ way):
                break
            size /= 2
        else:
            break
        s, g = size * way, turned - slope
        v, gain = v + s, value - after
        value, slope = after, turned
        if s @ g > 1e-12:
            steps = [*steps[-9:], (s, g, 1 / (s @ g))]
        if gain < 1e-7 * max(abs(value), 1):
            break
    return v[:-1], float(v[-1])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Classifier:
    """The classifier of all labelled rows whose remainder is not ``HELD_OUT``.

    Document counts of the n-grams, and so their ratios, come from all these
    rows; the weights from at most ``SAMPLE`` rows of each kind, weighed so that
    the kinds count as in all rows. Without labels every score is 0.5, with one
    kind of label it is the smoothed share of label 1.
    """
    wanted = training_labels(labels, doc_id, label)
    counted = settled(counts(labelled(docs, wanted, text, doc_id)))
    everything = counted.filter(F.col("bucket") == 1 << BITS).first()
    toxic, clean = (int(everything.toxic), int(everything.clean)) if everything else (0, 0)
    if not toxic or not clean:
        share = (toxic + 1) / (toxic + clean + 2) if toxic + clean else UNKNOWN
        return Classifier(np.zeros(0), float(np.log(share / (1 - share))))
    buckets, scale = ratios(counted, toxic, clean)
    places, starts, y = _sample(docs, wanted, text, doc_id, buckets)
    weight = np.where(y == 1, toxic / max(y.sum(), 1), clean / max((1 - y).sum(), 1))
    learned, intercept = logistic(places, starts, y, weight * len(y) / weight.sum(), scale)
    weights = np.zeros(1 << BITS)
    weights[buckets] = learned * scale
    return Classifier(weights, intercept)


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` per row.

    Scores are a function of the text alone, of all of it; a null text counts as
    empty and is scored like any. A row without an id is not held out.
    """
    classifier = fit(docs, labels, text, doc_id)
    scored = per_text(docs, lambda: lambda value: (classifier.score(value),), "score double", text, (doc_id,))
    held_out = F.coalesce(remainder(F.col(doc_id)) == HELD_OUT, F.lit(False))
    return scored.select(doc_id, held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
