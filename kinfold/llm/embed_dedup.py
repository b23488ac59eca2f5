"""Near duplicates among embeddings by int8 tile products with error bounds (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.batches import in_arrow
from kinfold.llm.components import connected_components, settled
from kinfold.llm.vectors import matrix, streamed, usable
from kinfold.skew import checked_broadcast

THRESHOLD = 0.98
RESIDENT = 16_384  # home vectors of one job
TILE = 1_024  # rows and columns of one product
PAIRS = 1 << 22  # bounds the pairs that a job holds, however dense the tile
PER_PIVOT = 200_000  # vectors for which there is one more pivot: a dozen blocks, of which a vector visits half
MOST_PIVOTS = 2_048  # bounds the pivots that go to the driver and to every task
HOME, SIBLING, STRANGER = 0, 1, 2  # of a job's own block, of another block of the cell, of another cell


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class Quantised:
    """Unit vectors as int8 multiples of a scale each, with the exact lengths of what is kept and what is lost."""

    def __init__(self, units: np.ndarray):
        self.scale = np.abs(units).max(axis=1) / 127
        self.codes = np.rint(units / self.scale[:, None]).astype(np.int8)
        kept = self.codes * self.scale[:, None]
        slack = 1 + 1e-9  # beyond the rounding of these sums
        self.length = np.sqrt((kept * kept).sum(axis=1)) * slack
        self.lost = np.sqrt(((units - kept) ** 2).sum(axis=1)) * slack + 1e-12


def possible_pairs(a: Quantised, b: Quantised, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose cosine can reach ``threshold``; no pair that reaches it is left out.

    With u = k + e and v = l + f (kept and lost parts), <u, v> differs from <k, l> by at
    most |k||f| + |e||l| + |e||f|. <k, l> is an int8 product: its sums stay below 2^24
    for up to 1,040 components, where single precision is exact; longer vectors use doubles.
    """
    kind = np.float32 if a.codes.shape[1] <= 1_040 else np.float64
    left, right = a.codes.astype(kind), b.codes.astype(kind)
    found = []
    for i in range(0, len(left), TILE):
        rows = slice(i, i + TILE)
        for j in range(0, len(right), TILE):
            columns = slice(j, j + TILE)
            product = left[rows] @ right[columns].T
            worst = (a.length[rows].max() + a.lost[rows].max()) * b.lost[columns].max() + a.lost[rows].max() * b.length[columns].max()
            least = (threshold - worst - 1e-6) / b.scale[columns]
            x, y = np.nonzero(product * a.scale[rows, None].astype(kind) >= least[None].astype(kind) * (1 - 1e-6 * np.sign(least)))
            x, y = x + i, y + j
            bound = a.length[x] * b.lost[y] + a.lost[x] * b.length[y] + a.lost[x] * b.lost[y]
            close = product[x - i, y - j].astype(float) * a.scale[x] * b.scale[y] + bound >= threshold - 1e-12
            found.append((x[close], y[close]))
    return tuple(np.concatenate(side) if found else np.zeros(0, int) for side in zip(*found)) if found else (np.zeros(0, int),) * 2


class Job:
    """Home vectors of one block against each other and all vectors that can be close to them."""

    def __init__(self, home: pa.Table, threshold: float):
        home = home.combine_chunks()
        self.threshold = threshold
        self.keys = home.column("key").to_pylist()
        self.copies = np.array(home.column("copies").to_pylist(), np.int64)
        self.units = unit(matrix(home.column("embedding").chunk(0)))
        self.quantised = Quantised(self.units)
        self.links = np.zeros(len(self.keys), np.int64)
        self.root = np.arange(len(self.keys))

    def _find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def visit(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Counts the links of the home vectors; edges come out only where they connect something new.

        A visitor of the same cell meets this block here only, so its links are counted too.
        """
        keys, copies = part.column("key").to_pylist(), part.column("copies").to_numpy()
        yield from self._meet(keys, copies, unit(matrix(part.column("embedding"))), part.column("visitor")[0].as_py() == SIBLING)

    def _meet(self, keys: list, copies: np.ndarray, units: np.ndarray, both: bool) -> Iterator[pa.RecordBatch]:
        step = max(1, min(TILE, PAIRS // len(self.keys)))
        for at in range(0, len(keys), step):
            some = slice(at, at + step)
            yield from self._meet_tile(keys[some], copies[some], units[some], both)

    def _meet_tile(self, keys: list, copies: np.ndarray, units: np.ndarray, both: bool) -> Iterator[pa.RecordBatch]:
        x, y = possible_pairs(self.quantised, Quantised(units), self.threshold)
        linked = np.zeros(len(x), bool)
        for at in range(0, len(x), 1 << 16):  # full precision for what the bounds leave open
            some = slice(at, at + (1 << 16))
            linked[some] = np.einsum("ij,ij->i", self.units[x[some]], units[y[some]]) >= self.threshold
        x, y = x[linked], y[linked]
        if not len(x):
            return
        np.add.at(self.links, x, copies[y])
        if both:
            found = np.zeros(len(keys), np.int64)
            np.add.at(found, y, self.copies[x])
            some = np.flatnonzero(found)
            yield _rows([keys[place] for place in some], [None] * len(some), found[some].tolist())
        order = np.argsort(y, kind="stable")
        x, y = x[order], y[order]
        # One edge from each visitor to its first home vector; more only between home vectors not yet connected.
        visitor, first = np.unique(y, return_index=True)
        centre = np.repeat(x[first], np.diff(np.append(first, len(y))))
        a = [keys[place] for place in visitor]
        b = [self.keys[place] for place in x[first]]
        edges = [(one, other) for one, other in zip(a, b) if one != other]
        apart = self.root[x] != self.root[centre]
        for one, other in zip(centre[apart].tolist(), x[apart].tolist()):
            low, high = sorted((self._find(one), self._find(other)))
            if low != high:
                self.root[high] = low
                edges.append((self.keys[one], self.keys[other]))
        while not np.array_equal(shorter := self.root[self.root], self.root):
            self.root = shorter
        if edges:
            yield _rows(*map(list, zip(*edges)), [None] * len(edges))

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self._meet(self.keys, self.copies, self.units, False)  # each other
        yield _rows(self.keys, [None] * len(self.keys), self.links.tolist())


def _rows(a: list, b: list, links: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(links, pa.int64())], names=["a", "b", "links"])


def _cells(pivots: dict[int, np.ndarray], threshold: float):
    """Each vector once in its own cell as ``home``, and in every cell that may hold a vector close to it.

    The own cell is that of the nearest pivot. A vector whose distance to the
    plane between its pivot and another exceeds the largest distance of a linked
    pair has no partner beyond that plane.
    """
    reach = sqrt(max(2 - 2 * threshold, 0)) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                places = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(places))
                centres = pivots.get(int(size))
                if centres is None or len(centres) == 1:
                    row, cell, home = np.arange(len(places)), np.zeros(len(places), int), np.ones(len(places), bool)
                else:
                    near = unit(matrix(part.column("embedding"))) @ centres.T
                    own = near.argmax(axis=1)
                    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
                    lead = near.max(axis=1, keepdims=True) - near
                    row, cell = np.nonzero(lead <= reach * apart[own] + 1e-9)
                    home = own[row] == cell
                chosen = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*(chosen.column(name) for name in ("label", "size", "key", "copies", "embedding")), pa.array(cell, pa.int32()), pa.array(home)],
                    names=["label", "size", "key", "copies", "embedding", "cell", "home"],
                )

    return run


def link_rows(classes: DataFrame, threshold: float = THRESHOLD, resident: int = RESIDENT) -> DataFrame:
    """``a``, ``b``, ``links``: links of a class with copies, which add up over rows (``b`` null), and edges that span the components (``links`` null).

    ``classes`` (``label``, ``key``, ``copies``, ``embedding``) holds each different
    vector of a label once. A large cell is dealt out in blocks of home vectors.
    The blocks stand in a circle: a vector visits the half of the others that
    follow its own, so two blocks meet once, and vectors from other cells visit all.
    No job holds more than one block and one batch.
    """
    classes = classes.withColumn("size", F.size("embedding"))
    count = classes.count()
    wanted = min(MOST_PIVOTS, ceil(count / PER_PIVOT))
    pivots: dict[int, list] = {}
    if wanted > 1:  # keys are digests, so the smallest ones are a fair sample
        for row in classes.orderBy("key").limit(wanted).select("size", "embedding").collect():
            pivots.setdefault(row["size"], []).append(row["embedding"])
    centres = {size: unit(np.array(rows, float)) for size, rows in pivots.items()}
    group = ["label", "size", "cell"]
    fields = f"label {classes.schema['label'].dataType.simpleString()}, size int, key string, copies bigint, embedding {classes.schema['embedding'].dataType.simpleString()}, cell int, home boolean"
    placed = in_arrow(classes.select("label", "size", "key", "copies", "embedding"), _cells(centres, threshold), fields)
    sizes = placed.filter("home").groupBy(*group).agg(F.ceil(F.count("*") / resident).cast("int").alias("blocks"))
    blocks = checked_broadcast(sizes.filter("blocks > 1"), settle=True)  # a row for several blocks of vectors
    placed = placed.join(blocks, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    # Opposite blocks, where their number is even, meet in one of the two only.
    half = F.floor((F.col("blocks") - 1) / 2).cast("int") + F.when((F.col("blocks") % 2 == 0) & (block < F.col("blocks") / 2), 1).otherwise(0)
    meet = lambda at, visitor: F.struct(at.cast("int").alias("block"), F.lit(visitor).alias("visitor"))
    others = F.transform(F.filter(F.sequence(F.lit(0), half), lambda step: step > 0), lambda step: meet((block + step) % F.col("blocks"), SIBLING))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda at: meet(at, STRANGER))
    met = F.when(F.col("home"), F.concat(F.array(meet(block, HOME)), others)).otherwise(every)
    dealt = placed.withColumn("met", F.explode(met)).select(*group, "met.block", "met.visitor", "key", "copies", "embedding")
    group.append("block")
    ordered = dealt.repartition(*group).sortWithinPartitions(*group, "visitor", "key")
    return in_arrow(ordered, lambda batches: streamed(batches, group, lambda home: Job(home, threshold)), "a string, b string, links bigint")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` per row.

    Rows link when their labels are equal and their cosine reaches ``threshold``.
    A null label, a vector that is null, empty, zero, or holds a null or non-finite component
    links with nothing; vectors of different length never link. Repeated rows are rows of their own
    and link with one another. A component of rows without ids has a null
    ``component_id``; a row without an id is never kept.
    """
    linkable = usable(F.col(embedding)) & F.exists(embedding, lambda x: x != 0) & F.col(label).isNotNull()
    digest = F.md5(F.concat_ws("|", F.col(label).cast("string"), F.col(embedding).cast("string")).cast("binary"))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(linkable, digest).alias("key"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    classes = settled(
        rows.filter("key is not null")
        .groupBy("key")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    )
    found = settled(link_rows(classes.select("label", "key", "copies", "embedding"), threshold))
    counts = found.filter("links is not null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    groups = connected_components(found.filter("links is null").select("a", "b")).withColumnRenamed("node", "key")
    named = settled(
        classes.select("key", "least").join(groups, "key", "left").withColumn("component", F.coalesce("component", "key"))
    )
    least = settled(named.groupBy("component").agg(F.min("least").alias("component_id")))
    known = settled(named.join(least, "component").join(counts, "key").select("key", "component_id", "links"))
    own = F.coalesce("key", F.concat(F.lit("-"), F.xxhash64("vec_id").cast("string"))).alias("key")
    alone = F.col("links").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", own).join(known, "key", "left").select(
        F.col("vec_id").alias(vec_id),
        F.coalesce(F.col("links") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
