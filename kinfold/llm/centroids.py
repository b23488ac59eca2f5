"""Exact k-means rounds with ns-bounds (operator 11)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.batches import in_arrow
from kinfold.llm.components import settled
from kinfold.llm.vectors import matrix, usable

CLUSTERS, ROUNDS, WIDTH, SCALE = 8, 10, 64, 1024
BLOCK = 4_096  # vectors in a row of the state
LARGEST = 1 << 27  # of a scaled component, so that a squared distance over 64 of them fits a long
SLACK = 1e-6  # relative; far beyond the rounding of the stored single precision bounds


def scaled(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


class Bounds:
    """Assignments of a block of vectors, with the distances found so far and the rounds they were found in.

    ``near[i, j]`` is the distance of vector i to centroid j as it was in round
    ``seen[i, j]``. Centroid j can have come nearer by no more than the norm of
    its total displacement since then, which the history of centroids gives; the
    sum of its steps, which is larger, is not needed.
    """

    def __init__(self, points: np.ndarray, owner: np.ndarray, near: np.ndarray, seen: np.ndarray):
        self.points, self.owner, self.near, self.seen = points, owner, near, seen

    @classmethod
    def fresh(cls, points: np.ndarray, k: int) -> Bounds:
        """Distances of zero, which rule nothing out."""
        n = len(points)
        return cls(points, np.zeros(n, np.int32), np.zeros((n, k), np.float32), np.zeros((n, k), np.int16))

    def distances(self, rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        """Exact squared distances."""
        return ((self.points[rows].astype(np.int64) - centroid) ** 2).sum(1)

    def advance(self, history: list[np.ndarray]) -> int:
        """Moves every vector to its nearest centroid of the last entry of ``history``; returns the distances worked out.

        A vector stays without a distance while all lower bounds lie above its
        upper bound. Otherwise the distance to its own centroid is worked out,
        then that to each centroid whose bound still fails; ties go to the smaller number.
        """
        now, last = len(history) - 1, history[-1]
        k, everyone = len(last), np.arange(len(self.owner))
        moved = np.stack([np.sqrt(((last - old).astype(float) ** 2).sum(1)) for old in history])
        loosened = moved[self.seen, np.arange(k)] * (1 + SLACK)
        low = self.near * (1 - SLACK) - loosened
        high = self.near[everyone, self.owner] * (1 + SLACK) + loosened[everyone, self.owner]
        failed = low <= high[:, None]
        failed[everyone, self.owner] = False
        rows = np.flatnonzero(failed.any(1))
        if not len(rows):
            return 0
        best = np.empty(len(rows), np.int64)
        for j in range(k):
            own = np.flatnonzero(self.owner[rows] == j)
            best[own] = self.distances(rows[own], last[j])
        self.near[rows, self.owner[rows]] = np.sqrt(best)
        self.seen[rows, self.owner[rows]] = now
        work = len(rows)
        still = low[rows] <= (np.sqrt(best) * (1 + SLACK))[:, None]
        before = self.owner[rows]
        still[np.arange(len(rows)), before] = False
        nearest = before.copy()
        for j in range(k):
            open_ = np.flatnonzero(still[:, j])
            found = self.distances(rows[open_], last[j])
            self.near[rows[open_], j] = np.sqrt(found)
            self.seen[rows[open_], j] = now
            work += len(open_)
            better = (found < best[open_]) | ((found == best[open_]) & (j < nearest[open_]))
            best[open_[better]], nearest[open_[better]] = found[better], j
        self.owner[rows] = nearest
        return work

    def totals(self) -> np.ndarray:
        """Per centroid the number of its vectors, then the sums of their components."""
        k = self.near.shape[1]
        members = np.zeros((k, len(self.owner)))
        members[self.owner, np.arange(len(self.owner))] = 1
        if np.abs(self.points, dtype=np.int64).sum() < 1 << 52:  # then products in doubles are exact
            sums = (members @ self.points.astype(float)).astype(np.int64)
        else:
            sums = np.stack([self.points[self.owner == j].astype(np.int64).sum(0) for j in range(k)])
        return np.column_stack([members.sum(1).astype(np.int64), sums])


def _blocks(rows: DataFrame, k: int, width: int) -> DataFrame:
    """The state before the first round: ids, components in as few bytes as they take, and empty bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                points = matrix(part.column("e")).astype(np.int64)
                if np.abs(points).max() > LARGEST:
                    raise ValueError(f"a scaled component is beyond {LARGEST}: its distances do not fit a long")
                points = points.astype(np.int16 if np.abs(points).max() < 1 << 15 else np.int32)
                yield _packed(part.column("id"), Bounds.fresh(points, k), 0)

    kind = rows.schema["id"].dataType.simpleString()
    return in_arrow(rows, run, _state_fields(kind))


def _state_fields(kind: str) -> str:
    return f"ids array<{kind}>, points binary, owner binary, near binary, seen binary, totals array<bigint>, work bigint"


def _packed(ids: pa.Array, state: Bounds, work: int) -> pa.RecordBatch:
    def blob(values: np.ndarray) -> pa.Array:
        return pa.array([values.tobytes()], pa.binary())

    totals = state.totals().ravel()
    columns = [
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        *(blob(values) for values in (state.points, state.owner, state.near, state.seen)),
        pa.array([totals.tolist()], pa.list_(pa.int64())),
        pa.array([work], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["ids", "points", "owner", "near", "seen", "totals", "work"])


def _unpacked(batch: pa.RecordBatch, at: int, k: int, width: int) -> tuple[pa.Array, Bounds]:
    ids = batch.column("ids")[at].values
    n = len(ids)
    read = lambda name, kind: np.frombuffer(batch.column(name)[at].as_py(), kind)
    raw = batch.column("points")[at].as_py()
    points = np.frombuffer(raw, np.int16 if len(raw) == 2 * n * width else np.int32).reshape(n, width)
    near, seen = read("near", np.float32).reshape(n, k), read("seen", np.int16).reshape(n, k)
    return ids, Bounds(points, read("owner", np.int32).copy(), near.copy(), seen.copy())


def _round(state: DataFrame, history: list[np.ndarray]) -> DataFrame:
    k, width = history[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, bounds = _unpacked(batch, at, k, width)
                work = bounds.advance(history)
                yield _packed(ids, bounds, work)

    return settled(in_arrow(state, run, state.schema))


def _moved(state: DataFrame, last: np.ndarray) -> np.ndarray:
    """Floors of the means; a centroid without vectors stays. The driver gets one number per component and centroid."""
    k, width = last.shape
    numbers = state.select(F.posexplode("totals").alias("place", "value"))
    sums = numbers.groupBy("place").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("total"))
    totals = [0] * (k * (width + 1))
    for row in sums.collect():
        totals[row.place] = int(row.total)
    moved = last.copy()
    for j in range(k):
        count, *values = totals[j * (width + 1) : (j + 1) * (width + 1)]
        if count:
            moved[j] = [value // count for value in values]
    return moved


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    seed: str = "3:",
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256`` per usable vector.

    Vectors that are null, have another number of components than ``width`` or
    hold a null or non-finite one are left out. Each round reads the state of the
    one before (blocks of vectors with their bounds, in the checkpoint folder), so
    nothing is shuffled but the sums of each task, and a
    lost executor costs its part of a round. First centroids are the vectors of
    smallest hash; of equal ids (equal hashes) the smaller components come first. A row
    without an id takes part but starts no centroid. With fewer vectors than
    ``clusters`` there are fewer centroids; if no vector has an id, there is no result row.
    """
    fits = usable(F.col(embedding)) & (F.size(embedding) == width)
    rows = vectors.filter(fits).select(F.col(vec_id).alias("id"), scaled(F.col(embedding)).alias("e"))
    mark = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = rows.filter("id is not null").select(mark.alias("mark"), "e").orderBy("mark", "e").limit(clusters).collect()
    kind = rows.schema["id"].dataType.simpleString()
    if not first:
        fields = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], f"`{vec_id}` {kind}, {fields}")
    history = [np.array([row.e for row in first], np.int64)]
    k = len(first)
    state = settled(_blocks(rows, k, width))
    for _ in range(rounds):
        state = _round(state, history)
        history.append(_moved(state, history[-1]))
    return _result(_round(state, history), history[-1], vec_id, kind)


def _result(state: DataFrame, last: np.ndarray, vec_id: str, kind: str) -> DataFrame:
    k, width = last.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, bounds = _unpacked(batch, at, k, width)
                distance = np.zeros(len(ids), np.int64)
                for j in range(k):
                    own = np.flatnonzero(bounds.owner == j)
                    distance[own] = bounds.distances(own, last[j])
                yield pa.RecordBatch.from_arrays([ids, pa.array(bounds.owner), pa.array(distance)], names=["id", "cluster", "distance"])

    rows = settled(in_arrow(state.select("ids", "points", "owner", "near", "seen"), run, f"id {kind}, cluster int, distance bigint"))
    found = {row.cluster: int(row.total) for row in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    per_cluster = F.array(*(F.lit(found.get(j, 0)).cast("bigint") for j in range(k)))
    digests = F.array(*(F.lit(hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for row in last.tolist()))
    return rows.select(
        F.col("id").alias(vec_id),
        "cluster",
        "distance",
        F.get(per_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(found.values())).cast("bigint").alias("inertia"),
        F.get(digests, F.col("cluster")).alias("centroid_sha256"),
    )
