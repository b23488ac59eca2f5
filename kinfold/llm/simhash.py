"""SimHash near duplicates by a binary trie self-join (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.batches import in_arrow, per_text
from kinfold.llm.components import connected_components, settled

SHINGLE = 3
SEED = 42
BITS = 3  # differing bits at which fingerprints still link
BLOCK = 16  # leading trie levels that a pair has in common in at least one of the rotated orders
WIDE = 100_000  # members from which a trie node is dealt out as pairs of its descendants
DEAL = 8  # levels below a wide node at which those pairs start
SMALL = 256  # leaf pairs of two nodes that are compared at once
CHUNK = 500_000  # fingerprints walked at once
STEP = 200_000  # node pairs taken a level down at once
LOW = (1 << (64 - BLOCK)) - 1


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles as a signed integer; 0 without words.

    Only A-Z are lower-cased and only ASCII white space parts words. Fewer words
    than a shingle give one hash of all of them. Repeated shingles count again.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [end + at for at, end in enumerate(accumulate(map(len, words)))]
    starts = [0, *(end + 1 for end in ends[:-1])]
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])] or [xxh64_intdigest(joined, SEED)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """``keys`` and ``fp`` (bigint) per row; a null or blank text has fingerprint 0."""
    return per_text(docs, lambda: lambda value: (fingerprint(value),), "fp bigint", text, keys)


class Forest:
    """Which leaves are connected so far, by the smallest index of each component."""

    def __init__(self, size: int):
        self.root = np.arange(size)
        self._run_ends()

    def _run_ends(self) -> None:
        """For each leaf the end of the run of following leaves in the same component."""
        size = len(self.root)
        cuts = np.flatnonzero(np.diff(self.root)) + 1
        bounds = np.concatenate([cuts, [size]])
        self.run_end = np.repeat(bounds, np.diff(np.concatenate([[0], bounds])))

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        changed = False
        while True:
            one, other = self.root[a], self.root[b]
            apart = one != other
            if not apart.any():
                break
            a, b, one, other = a[apart], b[apart], one[apart], other[apart]
            np.minimum.at(self.root, np.maximum(one, other), np.minimum(one, other))
            while not np.array_equal(shorter := self.root[self.root], self.root):
                self.root = shorter
            changed = True
        if changed:
            self._run_ends()

    def one(self, a_low, a_high, b_low, b_high) -> np.ndarray:
        """Node pairs whose leaves are all in one component already: nothing is left to find there."""
        return (self.run_end[a_low] >= a_high) & (self.run_end[b_low] >= b_high) & (self.root[a_low] == self.root[b_low])


def join_tries(keys: np.ndarray, pairs: np.ndarray, budget: int = BITS) -> np.ndarray:
    """Component of each key under links of at most ``budget`` differing bits.

    ``keys`` are sorted and distinct; a trie node is a range of them. ``pairs``
    has a row (low, high, low, high, differing bits so far, next bit) per pair of nodes
    to walk together. Each step splits both nodes at the next bit, adds one
    for the two children pairs that differ there, and drops pairs over budget and
    pairs that are connected already. Small pairs are compared leaf by leaf.
    """
    forest = Forest(len(keys))
    stack = [pairs[at : at + STEP] for at in range(0, len(pairs), STEP)]
    while stack:
        a_low, a_high, b_low, b_high, used, bit = stack.pop().T
        sizes = (a_high - a_low) * (b_high - b_low)
        small = (sizes <= SMALL) | (bit < 0)
        if small.any():
            for part in _batches(sizes * small):
                _compare(keys, forest, a_low[part], a_high[part], b_low[part], b_high[part], budget)
        go = ~small
        go[go] = ~forest.one(a_low[go], a_high[go], b_low[go], b_high[go])
        if not go.any():
            continue
        a_low, a_high, b_low, b_high, used, bit = (x[go] for x in (a_low, a_high, b_low, b_high, used, bit))
        a_mid, b_mid = _middle(keys, a_low, bit), _middle(keys, b_low, bit)
        a_mid, b_mid = np.minimum(a_mid, a_high), np.minimum(b_mid, b_high)
        same = (a_low == b_low) & (a_high == b_high)
        children = []
        for a0, a1, b0, b1, more, wanted in (
            (a_low, a_mid, b_low, b_mid, 0, None),
            (a_mid, a_high, b_mid, b_high, 0, None),
            (a_low, a_mid, b_mid, b_high, 1, None),
            (a_mid, a_high, b_low, b_mid, 1, ~same),  # within one node the mirror image of the row before
        ):
            kept = (a1 > a0) & (b1 > b0) & (used + more <= budget)
            if wanted is not None:
                kept &= wanted
            children.append(np.stack([x[kept] for x in (a0, a1, b0, b1, used + more, bit - 1)], axis=1))
        # The closest pairs come off the stack first: what they connect prunes the others.
        children = np.concatenate(children)
        stack += [children[at : at + STEP] for at in reversed(range(0, len(children), STEP))]
    return forest.root


def _middle(keys: np.ndarray, low: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """First place below a node whose key has ``bit`` set."""
    at = bit.astype(np.uint64)
    one = np.uint64(1)
    return np.searchsorted(keys, ((keys[low] >> (at + one)) << (at + one)) | (one << at))


def _batches(weights: np.ndarray, most: int = 2_000_000) -> Iterator[np.ndarray]:
    chosen = np.flatnonzero(weights)
    if len(chosen):
        total = np.cumsum(weights[chosen])
        yield from np.split(chosen, np.flatnonzero(np.diff(total // most)) + 1)


def _compare(keys, forest: Forest, a_low, a_high, b_low, b_high, budget: int) -> None:
    """Link all leaves of each pair of small nodes that differ in at most ``budget`` bits."""
    width = b_high - b_low
    sizes = (a_high - a_low) * width
    pair = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    a, b = a_low[pair] + nth // width[pair], b_low[pair] + nth % width[pair]
    close = (a < b) & (np.bitwise_count(keys[a] ^ keys[b]) <= budget)
    forest.link(a[close], b[close])


def _rotated(fp: str, turns: str) -> str:
    return f"(shiftleft({fp}, {turns}) | CASE WHEN {turns} = 0 THEN 0L ELSE shiftrightunsigned({fp}, 64 - {turns}) END)"


def trie_links(distinct: DataFrame, budget: int = BITS) -> DataFrame:
    """``a``, ``b``: links that connect just the fingerprints which chains of close pairs connect.

    ``distinct`` has ``fp``, each once. Of 64 bits in blocks of 16, two
    fingerprints with up to three differing bits have one block in common. The
    trie is therefore laid out in four rotated orders, each block leading once, and
    the nodes below a common block are walked as pairs, many nodes per task. A
    node with more than ``WIDE`` members is dealt out as pairs of its descendants
    eight levels down, each with its differing bits so far. Inside a task
    connected nodes are not walked again and only a spanning forest comes out, so
    a dense group costs neither a pair list nor a quadratic walk.
    """
    if budget >= 64 // BLOCK:
        raise ValueError("a budget of four or more bits needs smaller blocks")
    turns = F.explode(F.sequence(F.lit(0), F.lit(64 - BLOCK), F.lit(BLOCK))).alias("turns")
    laid = (
        distinct.select("fp", turns)
        .withColumn("key", F.expr(_rotated("fp", "turns")))
        .withColumn("node", F.expr(f"shiftrightunsigned(key, {64 - BLOCK})"))
    )
    sizes = laid.groupBy("turns", "node").agg(F.count("*").alias("members"))
    wide = settled(sizes.filter(F.col("members") > WIDE).select("turns", "node", F.lit(True).alias("wide")))
    masks = [sum(1 << bit for bit in bits) for n in range(budget + 1) for bits in combinations(range(DEAL), n)]
    branch = F.expr(f"shiftrightunsigned(key, {64 - BLOCK - DEAL}) & {(1 << DEAL) - 1}").cast("int")
    if wide.isEmpty():
        dealt = laid.withColumns({"one": F.lit(-1), "other": F.lit(-1)})
    else:
        other = lambda mask: F.col("branch").bitwiseXOR(mask)
        paired = F.transform(
            F.lit(masks).cast("array<int>"),
            lambda mask: F.struct(F.least("branch", other(mask)).alias("one"), F.greatest("branch", other(mask)).alias("other")),
        )
        whole = F.array(F.struct(F.lit(-1).alias("one"), F.lit(-1).alias("other")))
        dealt = (
            laid.withColumn("branch", branch)
            .join(wide, ["turns", "node"], "left")
            .withColumn("pair", F.explode(F.when(F.col("wide"), paired).otherwise(whole)))
            .select("fp", "turns", "key", "node", "pair.one", "pair.other")
        )
    group = ["turns", "node", "one", "other"]
    ordered = (
        dealt.repartition(*group)
        .withColumn("low", F.expr(f"key & {LOW}L"))
        .select(*group, "low", "fp")
        .sortWithinPartitions(*group, "low")
    )
    return in_arrow(ordered, _walk(budget), "a bigint, b bigint")


def _walk(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            if batch.num_rows:
                held.append(np.stack([batch.column(name).to_numpy() for name in ("turns", "node", "one", "other", "low", "fp")], axis=1))
                rows += batch.num_rows
            if rows >= CHUNK:  # all but the last group are complete
                table = np.concatenate(held)
                starts = _group_starts(table)
                if len(starts) > 1:
                    yield from _linked(table[: starts[-1]], starts[:-1], budget)
                    table = table[starts[-1] :]
                held, rows = [table], len(table) if len(starts) > 1 else 0
        if held:
            table = np.concatenate(held)
            yield from _linked(table, _group_starts(table), budget)

    return run


def _group_starts(table: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], (np.diff(table[:, :4], axis=0) != 0).any(axis=1)]))


def _linked(table: np.ndarray, starts: np.ndarray, budget: int) -> Iterator[pa.RecordBatch]:
    """Links of complete groups, at most 2^16 groups at once: their number leads the keys."""
    bounds = np.append(starts, len(table))
    for first in range(0, len(starts), 1 << BLOCK):
        own = bounds[first : first + (1 << BLOCK) + 1]
        part, edges = table[own[0] : own[-1]], own - own[0]
        number = np.repeat(np.arange(len(edges) - 1), np.diff(edges)).astype(np.uint64)
        keys = (number << np.uint64(64 - BLOCK)) | part[:, 4].astype(np.uint64)
        low, high = edges[:-1], edges[1:]
        pairs = np.stack([low, high, low, high, np.zeros_like(low), np.full_like(low, 63 - BLOCK)], axis=1)
        crossed = part[low, 2] != part[low, 3]
        if crossed.any():  # two descendants of a wide node: the first one's leaves come first
            prefix = part[low, 3].astype(np.uint64) << np.uint64(64 - BLOCK - DEAL)
            middle = np.searchsorted(keys, (np.arange(len(low)).astype(np.uint64) << np.uint64(64 - BLOCK)) | prefix)
            pairs[crossed, 1] = pairs[crossed, 2] = middle[crossed]
            pairs[crossed, 4] = np.bitwise_count(part[low, 2] ^ part[low, 3])[crossed]
        below = part[low, 2] >= 0
        pairs[below, 5] -= DEAL
        kept = (pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2]) & (pairs[:, 3] - pairs[:, 0] > 1)
        root = join_tries(keys, pairs[kept], budget)
        linked = np.flatnonzero(root != np.arange(len(root)))
        if len(linked):
            yield pa.RecordBatch.from_arrays([pa.array(part[linked, 5]), pa.array(part[root[linked], 5])], names=["a", "b"])


def near_duplicates(marked: DataFrame, budget: int = BITS, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``marked`` (with ``fp``) and ``component_id``, the smallest ``doc_id`` of each component.

    Equal fingerprints are one class, so copies cost no pairs. A component of
    rows that all lack an id has a null ``component_id``; other null ids are passed
    over. Rows that repeat stay.
    """
    marked = settled(marked)
    distinct = settled(marked.groupBy("fp").agg(F.min(doc_id).alias("_least")))
    linked = connected_components(trie_links(distinct.select("fp"), budget))
    classes = settled(
        distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", F.coalesce("component", "fp").alias("component"), "_least"
        )
    )
    least = settled(classes.groupBy("component").agg(F.min("_least").alias("component_id")))
    named = settled(classes.join(least, "component").select("fp", "component", "component_id"))
    return marked.join(named, "fp")


def hexadecimal(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each component, the one of smallest id (then smallest text hash); all columns stay.

    A null id goes after all others. Rows that repeat an id and text are one row. A
    null text counts as empty, and all blank texts are one component.
    """
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash")
    # A null id has a key as well, so the join and the repeated rows share one shuffle of the texts.
    row = F.col(doc_id).alias("row")
    key = F.coalesce(F.concat(F.lit("id "), F.col("row").cast("string")), F.lit("none")).alias("key")
    rows = docs.select(row, hashed, F.col(text).alias("text"))
    found = near_duplicates(fingerprints(rows, keys=("row", "hash")), doc_id="row")
    order = F.struct(F.col("row").isNull().alias("last"), "row", "hash")
    kept = found.groupBy("component").agg(F.min(order).alias("kept")).select("kept.*")
    kept = settled(kept.select(key, "hash"))
    whole = docs.select(F.struct("*").alias("all"), row, hashed).select("all", key, "hash")
    return whole.join(kept, ["key", "hash"], "left_semi").dropDuplicates(["key", "hash"]).select("all.*")
