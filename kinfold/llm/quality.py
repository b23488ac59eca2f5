"""Quality scores: random Fourier features, ridge normal equations, isotonic calibration (operator 7)."""

from __future__ import annotations

from dataclasses import dataclass
from math import log, sqrt
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.batches import SLICE, in_arrow, per_text
from kinfold.llm.components import settled
from kinfold.llm.sums import summed

WAVES = 192  # random Fourier features
RIDGE = 1.0
BINS = 2_000  # of raw scores, for the calibration
LOW, HIGH = -0.5, 1.5  # raw scores beyond count in the outer bins
FOLDS = 5  # remainder 0 is held out, the others leave one another out for the calibration
THRESHOLD = 0.3
UNKNOWN = 0.5  # the score where there are no labels at all

_SIGNS = {"marks": b"%$#&*@~^", "bars": b"|", "shouts": b"!", "stops": b".?", "commas": b",;:", "quotes": b"\"'()[]{}<>/\\=_+-"}
N_STATISTICS = 22


def statistics(text: str) -> list[float]:
    """Numbers of a fixed size about the whole text; an empty text has defined ones too."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(data, minlength=256)
    size = max(len(data), 1)
    words = text.split()
    n = max(len(words), 1)
    lines = text.split("\n")
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    shares = counts[counts > 0] / size
    signs = [sqrt(counts[np.frombuffer(chars, np.uint8)].sum() / n) for chars in _SIGNS.values()]
    distinct = len(set(words))
    return [
        log(len(data) + 1.0),
        log(len(words) + 1.0),
        log(len(data) / n + 1.0),
        upper / max(upper + lower, 1),
        sqrt(counts[48:58].sum() / size),
        counts[32] / size,
        log(size / len(lines)),
        counts[128:].sum() / size,
        *signs,
        log(distinct + 1.0) / log(n + 1.0),
        sqrt(sum(map(eq, words, words[1:])) / n),
        len(set(zip(words, words[1:]))) / n,
        len(set(lines)) / len(lines),
        sqrt(sum(map(str.isupper, words)) / n),
        sqrt(sum(map(str.isalpha, words)) / n),
        float(-(shares * np.log(shares)).sum()),
        max(map(len, words), default=0) ** 0.25,
    ]


def measured(docs: DataFrame, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """``keys`` and ``statistics`` (array of floats) per row."""
    return per_text(docs, lambda: lambda value: (statistics(value),), "statistics array<float>", text, keys)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text modulo ``FOLDS``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


@dataclass(frozen=True)
class Scorer:
    """What scoring a text takes: a few hundred numbers, whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray  # calibration: raw scores and the shares of label 1 there, both ascending
    share: np.ndarray

    def waves(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.scale, -8, 8)
        waves = np.cos(scaled @ self.frequencies + self.phases) * np.sqrt(2 / WAVES)
        return np.hstack([waves, np.ones((len(rows), 1))])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.raw):
            return np.full(len(rows), UNKNOWN)
        return np.clip(np.interp(self.waves(rows) @ self.weights, self.raw, self.share), 0, 1)


def _matrix(batch: pa.RecordBatch, name: str = "statistics") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float)


def fit(measured_rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> Scorer:
    """Fit on all labelled rows whose remainder is not 0.

    ``measured_rows`` has ``doc_id`` and ``statistics``. A document with several
    labels has their mean; null labels and null ids are passed over. Sums over
    partitions are all that leaves the tasks: first moments, then the normal
    equations of each remainder, then label counts per bin of raw score. Raw scores for
    the calibration come from a fit that left out the row's remainder.
    """
    wanted = labels.filter(F.col(label).isNotNull() & (remainder(F.col(doc_id)) != 0))
    wanted = wanted.groupBy(doc_id).agg(F.avg(F.col(label).cast("double")).alias("y"))
    train = settled(
        measured_rows.select(doc_id, "statistics").join(wanted, doc_id).select("statistics", "y", remainder(F.col(doc_id)).alias("fold"))
    )
    d = N_STATISTICS

    def moments(batch):
        rows = _matrix(batch)
        return np.concatenate([[len(rows)], rows.sum(0), (rows**2).sum(0)])

    sums = summed(train, moments, 2 * d + 1)
    n = sums[0]
    rng = np.random.default_rng(7)
    base = dict(
        mean=sums[1 : d + 1] / max(n, 1),
        scale=np.sqrt(np.maximum(sums[d + 1 :] / max(n, 1) - (sums[1 : d + 1] / max(n, 1)) ** 2, 1e-6)),
        frequencies=rng.normal(size=(d, WAVES)) / (1.2 * sqrt(d)),
        phases=rng.uniform(0, 2 * np.pi, WAVES),
    )
    empty = np.zeros(0)
    plain = Scorer(**base, weights=empty, raw=empty, share=empty)
    if not n:
        return plain
    width = WAVES + 1

    def equations(batch):
        waves, y = plain.waves(_matrix(batch)), batch.column("y").to_numpy()
        fold = batch.column("fold").to_numpy()
        out = np.zeros((FOLDS - 1, width, width + 1))
        for k in range(1, FOLDS):
            own = waves[fold == k]
            out[k - 1] = own.T @ np.column_stack([own, y[fold == k]])
        return out.ravel()

    parts = summed(train, equations, (FOLDS - 1) * width * (width + 1)).reshape(FOLDS - 1, width, width + 1)
    penalty = RIDGE * np.eye(width)
    penalty[-1, -1] = 1e-9
    solve = lambda part: np.linalg.solve(part[:, :-1] + penalty, part[:, -1])
    weights = solve(parts.sum(0))
    without = np.stack([solve(parts.sum(0) - part) if n > FOLDS else weights for part in parts])

    def binned(batch):
        waves, y, fold = plain.waves(_matrix(batch)), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
        raw = np.einsum("ij,ij->i", waves, without[fold - 1])
        place = np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(place, minlength=BINS), np.bincount(place, y, BINS)])

    bins = summed(train, binned, 2 * BINS)
    raw, share = isotonic(LOW + (np.arange(BINS) + 0.5) * (HIGH - LOW) / BINS, bins[:BINS], bins[BINS:])
    return Scorer(**base, weights=weights, raw=raw, share=share)


def isotonic(places: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places and never falling means: neighbours that fall are pooled."""
    blocks: list[list[float]] = []  # weight, sum, weighted place
    for place, count, total in zip(places, counts, sums):
        if not count:
            continue
        blocks.append([count, total, count * place])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks).reshape(-1, 3)
    return table[:, 2] / table[:, 0], table[:, 1] / table[:, 0]


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` per row.

    Scores are a function of the text alone. A null text counts as empty and is
    scored like any; a row without an id is not held out. Without any label all
    scores are 0.5. The statistics are made once and kept in the checkpoint folder.
    """
    rows = settled(measured(docs, text, (doc_id,)))
    scorer = fit(rows, labels, doc_id)

    def run(batches):
        for batch in batches:
            scores = scorer.scores(_matrix(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=[doc_id, "score"])

    scored = in_arrow(rows, run, f"{doc_id} {rows.schema[doc_id].dataType.simpleString()}, score double")
    held_out = F.coalesce(remainder(F.col(doc_id)) == 0, F.lit(False))
    return scored.select(doc_id, held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns.

    The fit reads the narrow statistics; then each task scores its own rows, so
    no text is shuffled.
    """
    scorer = fit(measured(docs, text, (doc_id,)), labels, doc_id)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                rows = np.array([statistics(value or "") for value in part.column(text).to_pylist()])
                yield part.filter(pa.array(scorer.scores(rows) >= threshold))

    return in_arrow(docs, run, docs.schema)
