"""Exact top-k search as a Voronoi kNN join over integer vectors (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.batches import in_arrow
from kinfold.llm.components import settled
from kinfold.llm.vectors import matrix, streamed, usable

K = 10
SCALE = 1_024
PER_PIVOT = 10_000  # queries for which there is one more pivot
LEAST_PIVOTS, MOST_PIVOTS = 8, 256  # the most bounds what goes to the driver and to every task
QUERIES = 8_192  # queries of one job
BLOCK = 65_536  # data rows of one job
STEP = 256  # data rows of one product
SLACK = 1 + 1e-9
LONG = (1 << 63) - 1


def scaled(column: pa.Array) -> np.ndarray:
    """floor(1024 x) of each component; whole numbers held in doubles."""
    return np.floor(SCALE * matrix(column))


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products. Where a sum may pass 2^53 Python's integers are used, cut off at the range of a long."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    if np.abs(queries).max() * np.abs(rows).max() * queries.shape[1] < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in rows]
    lines = [[int(x) for x in row] for row in queries]
    exact = [[max(-LONG - 1, min(LONG, sum(map(int.__mul__, a, b)))) for b in whole] for a in lines]
    return np.array(exact, np.int64)


class Job:
    """Queries of one bundle; data rows stream past by falling bound and the best k of each query stay."""

    def __init__(self, home: pa.Table, k: int):
        home = home.combine_chunks()
        self.k = k
        self.ids = np.array(home.column("vec_id").to_pylist(), np.int64)
        self.queries = scaled(home.column("embedding").chunk(0))
        self.least = np.full(len(self.ids), -LONG - 1)  # the k-th score so far
        self.query, self.owner, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def visit(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bound = part.column("bound").to_numpy()
        for at in range(0, part.num_rows, STEP):
            least = self.least.min()
            if least > -LONG - 1 and bound[at] < least:  # nor can any row after this one reach a k-th score
                break
            some = part.slice(at, STEP)
            ids = some.column("vec_id").to_numpy()
            scores = products(self.queries, scaled(some.column("embedding")))
            query, row = np.nonzero((scores >= self.least[:, None]) & (self.ids[:, None] != ids))
            if len(query):
                self._merge(query, ids[row], scores[query, row])
        return iter(())

    def _merge(self, query: np.ndarray, owner: np.ndarray, score: np.ndarray) -> None:
        query, owner, score = (np.concatenate(pair) for pair in ((self.query, query), (self.owner, owner), (self.score, score)))
        order = np.lexsort((owner, ~score, query))  # ~ turns the order without leaving the range
        query, owner, score = query[order], owner[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        self.query, self.owner, self.score = query[kept], owner[kept], score[kept]
        full = rank[kept] == self.k - 1
        self.least[self.query[full]] = self.score[full]

    def finish(self) -> Iterator[pa.RecordBatch]:
        columns = [self.ids[self.query], self.owner, self.score]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["query_id", "vec_id", "score"])


def _nearest(pivots: dict[int, np.ndarray]):
    """Adds the cell of the nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                rows, centres = scaled(part.column("embedding")), pivots[int(size)]
                far = (rows * rows).sum(1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(1)
                cell = far.argmin(axis=1)
                distance = np.sqrt(((rows - centres[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int32()), pa.array(distance)], names=[*part.schema.names, "cell", "distance"])

    return run


def bundled(centre: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """A bundle for each query group: neighbouring groups together, as long as they have no more than ``QUERIES`` queries."""
    bundle = np.full(len(queries), -1)
    for number in range(len(queries)):
        free = np.flatnonzero(bundle < 0)
        if not len(free):
            break
        away = ((centre[free] - centre[free[0]]) ** 2).sum(1)
        order = free[np.argsort(away, kind="stable")]
        order = order[np.argsort(order != free[0], kind="stable")]  # its own group first, whatever the rounding
        fits = np.cumsum(queries[order]) <= QUERIES
        bundle[order[0]] = number
        bundle[order[fits]] = number
    return bundle


class Plan:
    """What every task must know: pivots, reach of each query group, the score its queries are sure to find, its bundle."""

    def __init__(self, pivots: dict[int, np.ndarray], near: list, groups: list, rows: int, k: int):
        self.groups: dict[int, dict] = {}
        for size, centres in pivots.items():
            own = [row for row in groups if row["size"] == size]
            if not own:
                continue
            cells = np.array([row["cell"] for row in own])
            centre, reach = centres[cells], np.array([row["reach"] for row in own]) * SLACK
            length = np.sqrt((centre * centre).sum(1)) + reach
            data = [row for row in near if row["size"] == size]
            at, away = np.array([row["cell"] for row in data]), np.array([row["distance"] for row in data]) * SLACK
            # Row x of cell j: <q, x> >= <c, p> - reach |p| - (|c| + reach) |x - p|.
            pivot_length = np.sqrt((centres * centres).sum(1))
            sure = (centre @ centres.T)[:, at] - reach[:, None] * pivot_length[at] - length[:, None] * away
            # Each id counts once, whatever its rows and cells: all rows of the query's id are its own.
            owner = np.array([row["vec_id"] for row in data], np.int64)
            order = np.argsort(owner, kind="stable")
            firsts = np.flatnonzero(np.diff(owner[order], prepend=owner[order[0]] - 1))
            sure = np.sort(np.maximum.reduceat(sure[:, order], firsts, axis=1), axis=1)[:, ::-1]
            # One of the ids may be the query's own, so k others need k + 1.
            least = sure[:, k] if sure.shape[1] > k else np.full(len(own), -np.inf)
            # Scores are cut off at the range of a long, where more rows can tie.
            least = np.where(least < -(2.0**63), -np.inf, np.minimum(least, 2.0**63))
            bundle = bundled(centre, np.array([row["queries"] for row in own]))
            asked = np.bincount(bundle, [row["queries"] for row in own])
            self.groups[size] = {
                "bundle": bundle,
                "place": {int(cell): at for at, cell in enumerate(cells)},
                "centre": centre,
                "reach": reach,
                "least": least - 1e-9 * np.abs(least) - 1,
                "blocks": np.ceil(asked / QUERIES).astype(int),
                "data_blocks": ceil(rows / BLOCK),
            }


def _dealt(plan: Plan):
    """Queries to every data block of their bundle, data rows once to every bundle with a group whose bound they can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                if int(size) not in plan.groups:
                    continue
                group = plan.groups[int(size)]
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                rows = scaled(part.column("embedding"))
                spread = part.column("spread").to_numpy()
                query = part.column("query").to_numpy(zero_copy_only=False)
                out = []
                asked = np.flatnonzero(query)
                if len(asked):
                    place = np.array([group["place"][cell] for cell in part.column("cell").take(pa.array(asked)).to_pylist()])
                    bundle = group["bundle"][place]
                    block = spread[asked] % group["blocks"][bundle]
                    for data_block in range(group["data_blocks"]):
                        out.append((asked, bundle, block, np.full(len(asked), data_block), np.zeros(len(asked), int), np.zeros(len(asked))))
                bound = rows @ group["centre"].T + np.sqrt((rows * rows).sum(1))[:, None] * group["reach"] * SLACK
                bound += 1e-9 * np.abs(bound) + 1
                for bundle in range(len(group["blocks"])):
                    own = group["bundle"] == bundle
                    row = np.flatnonzero((bound[:, own] >= group["least"][own]).any(axis=1))
                    highest = bound[row][:, own].max(axis=1)
                    for block in range(group["blocks"][bundle]):
                        out.append((row, np.full(len(row), bundle), np.full(len(row), block), (spread[row] >> 8) % group["data_blocks"], np.ones(len(row), int), highest))
                row, bundle, block, data_block, visitor, highest = (np.concatenate(x) for x in zip(*out))
                chosen = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), size), pa.int32()),
                        *(pa.array(x, pa.int32()) for x in (bundle, block, data_block, visitor)),
                        pa.array(highest),
                        chosen.column("vec_id"),
                        chosen.column("embedding"),
                    ],
                    names=["size", "bundle", "block", "data_block", "visitor", "bound", "vec_id", "embedding"],
                )

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best other rows of each query row, ties to smaller ids.

    The score is the inner product of floor(1024 x). Rows without an id, and
    vectors that are null, empty or hold a null or non-finite component take no part; only
    vectors of equal length are compared; rows with the query's id are its own.
    Repeated rows are candidates each; several query rows of one id share their
    ``k`` best. Scores beyond the range of a long are cut off there.

    Queries and data are grouped by pivots. From the summaries (each query
    group's reach, the distances of the k + 1 different ids nearest to each pivot) follows a score
    that every query of a group is sure to find; a data row is of use only to groups
    where its bound reaches that. Neighbouring groups of few queries form a
    bundle, to which a row goes once. Large groups are dealt out in blocks of queries
    and of data, and the best of the blocks are merged. A block meets its rows by
    falling bound and stops where no query can gain any more.
    """
    rows = vectors.filter(F.col(vec_id).isNotNull() & usable(F.col(embedding))).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("embedding"), F.size(embedding).alias("size"), is_query.alias("query")
    )
    total, asked = rows.agg(F.count("*"), F.count_if("query")).first()
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, ceil(asked / PER_PIVOT)))
    first = rows.groupBy("size").agg(F.min("vec_id").alias("vec_id"))  # a pivot for every length of vector
    chosen = rows.orderBy(F.xxhash64("embedding"), "vec_id").limit(wanted).select("vec_id", "size", "embedding")
    kind = vectors.schema[embedding].dataType.simpleString()
    result = "query_id bigint, vec_id bigint, score bigint"
    pivots: dict[int, list] = {}
    for row in chosen.collect() + rows.join(first, ["size", "vec_id"]).select("vec_id", "size", "embedding").dropDuplicates(["size"]).collect():
        pivots.setdefault(row["size"], []).append(row["embedding"])
    centres = {size: np.unique(np.floor(SCALE * np.array(values, float)), axis=0) for size, values in pivots.items()}
    spread = F.xxhash64("vec_id", "embedding").bitwiseAND(LONG).alias("spread")
    placed = settled(
        in_arrow(
            rows.select("vec_id", "size", "query", spread, "embedding"),
            _nearest(centres),
            f"vec_id bigint, size int, query boolean, spread bigint, embedding {kind}, cell int, distance double",
        )
    )
    by_cell = Window.partitionBy("size", "cell").orderBy("distance", "vec_id")
    closest = placed.groupBy("size", "cell", "vec_id").agg(F.min("distance").alias("distance"))
    near = closest.withColumn("nth", F.row_number().over(by_cell)).filter(F.col("nth") <= k + 1).collect()
    groups = placed.filter("query").groupBy("size", "cell").agg(F.max("distance").alias("reach"), F.count("*").alias("queries")).collect()
    plan = Plan(centres, near, groups, total, k)
    group = ["size", "bundle", "block", "data_block"]
    dealt = in_arrow(placed.select("vec_id", "size", "query", "spread", "embedding", "cell"), _dealt(plan), f"size int, bundle int, block int, data_block int, visitor int, bound double, vec_id bigint, embedding {kind}")
    ordered = dealt.repartition(*group).sortWithinPartitions(*group, "visitor", F.desc("bound"), "vec_id")
    found = in_arrow(ordered, lambda batches: streamed(batches, group, lambda home: Job(home, k)), result)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
