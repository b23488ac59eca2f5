"""Prefix trie of conversations with a balanced rollup by centroid decomposition (operator 13)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.batches import in_arrow
from kinfold.llm.components import settled

GROUP = 20  # conversations that share a base
SHARED = 4  # a conversation takes fewer turns than this from its base
LOCAL = 20_000  # a component of no more weight is split further inside one task
PIECE = 4_096  # ids joined at once
COMPONENTS = 500_000  # components whose few numbers (about 50 bytes each) are broadcast; more are joined by a shuffle
WORD = r"[^\x20\x09-\x0D]+"

# Sequences are told apart by a polynomial over the digests of their turns, modulo a Mersenne prime. Unlike a chain of
# digests it can be put together from parts, so one conversation may lie in many partitions.
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefixes").digest()[:15], "big")
ROOT = bytes(16)


@lru_cache(maxsize=100_000)
def power(n: int) -> int:
    return pow(BASE, n, PRIME)


def joined(head: int, tail: int, n: int) -> int:
    """The key of a sequence and ``n`` more turns whose own key is ``tail``."""
    return (head * power(n) + tail) % PRIME


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _bytes(number: int) -> bytes:
    return number.to_bytes(16, "big")


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``mark`` (digest of role and text) and ``words`` in order, dealt out by ranges of that order.

    Texts are not shuffled. Turns of equal number are ordered by the digest. Even
    one conversation with most of the rows, or one row repeated, is spread over the partitions.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.unhex(F.substring(digest, 1, 32)).alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("spread"),
    )
    order = ["conv_id", "turn", "mark", "spread"]
    return settled(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "mark", "words"))


def _carried(ordered: DataFrame) -> dict[int, tuple[int, int, int]]:
    """Conversation, turns and key that a partition takes over from those before it.

    Each partition reports its first and its last conversation, so the driver gets
    two rows a partition, whatever the data.
    """

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[list[int]] = []
        for batch in batches:
            for conv, mark in zip(batch.column("conv_id").to_pylist(), batch.column("mark").to_pylist()):
                if not runs or runs[-1][0] != conv:
                    runs[1:] = [[conv, 0, 0]]
                runs[-1][1] += 1
                runs[-1][2] = (runs[-1][2] * BASE + _number(mark) + 1) % PRIME
        part = TaskContext.get().partitionId()
        columns = [[part] * len(runs), [run[0] for run in runs], [run[1] for run in runs], [_bytes(run[2]) for run in runs]]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        names = ["part", "conv_id", "n", "key"]
        yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, kinds)], names=names)

    found: dict[int, list] = {}
    for row in in_arrow(ordered, ends, "part int, conv_id bigint, n bigint, key binary").collect():
        found.setdefault(row.part, []).append((row.conv_id, row.n, _number(bytes(row.key))))
    start, open_ = {}, None
    for part in sorted(found):
        first = found[part][0]
        if open_ and open_[0] == first[0]:
            start[part] = open_
            first = (first[0], open_[1] + first[1], joined(open_[2], first[2], first[1]))
        open_ = first if len(found[part]) == 1 else found[part][1]
    return start


def numbered(ordered: DataFrame) -> DataFrame:
    """``conv_id``, ``nth`` (from 1), ``key`` of the turns up to this one, ``before`` (without it) and ``words``."""
    carried = _carried(ordered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, nth, key = carried.get(TaskContext.get().partitionId(), (None, 0, 0))
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for now, mark in zip(batch.column("conv_id").to_pylist(), batch.column("mark").to_pylist()):
                if now != conv:
                    conv, nth, key = now, 0, 0
                out[2].append(_bytes(key))
                nth, key = nth + 1, (key * BASE + _number(mark) + 1) % PRIME
                out[0].append(nth)
                out[1].append(_bytes(key))
            columns = [batch.column("conv_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()), batch.column("words")]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "nth", "key", "before", "words"])

    return settled(in_arrow(ordered, run, "conv_id bigint, nth bigint, key binary, before binary, words bigint"))


def _rebuilt(own: DataFrame) -> DataFrame:
    """Per conversation its turns dropped (``h``) and taken from its base (``taken``), keys there, and its length."""
    heads = [F.max(F.when(F.col("nth") == i, F.col(name))).alias(f"{name}{i}") for name in ("key", "words") for i in range(1, SHARED)]
    table = settled(own.groupBy("conv_id").agg(F.max("nth").alias("n"), *heads))
    table = table.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED)
    base = table.select(F.col("conv_id").alias("base_id"), F.col("n").alias("base_n"), *(F.col(f"{name}{i}").alias(f"base_{name}{i}") for name in ("key", "words") for i in range(1, SHARED)))
    both = table.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % GROUP).join(base, "base_id", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    keys = lambda prefix: F.array(F.lit(bytearray(ROOT)), *(F.col(f"{prefix}key{i}") for i in range(1, SHARED)))
    return settled(
        both.select(
            "conv_id",
            "h",
            taken.alias("taken"),
            (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
            F.get(keys(""), F.col("h").cast("int")).alias("dropped_key"),
            keys("base_").alias("base_keys"),
            F.array(F.lit(0).cast("bigint"), *(F.col(f"base_words{i}") for i in range(1, SHARED))).alias("base_words"),
        )
    )


def members(conversations: DataFrame) -> DataFrame:
    """A row per rebuilt conversation and depth, 0 included: ``conv_id``, ``depth``, ``key``, ``parent_key``, ``words``, ``length``."""
    own = numbered(turns(conversations))
    table = _rebuilt(own)
    at = F.col("depth").cast("int")
    heads = table.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), "taken")).alias("depth")).select(
        "conv_id", "depth", F.get("base_keys", at).alias("key"), F.get("base_keys", at - 1).alias("parent_key"), F.get("base_words", at).alias("words"), "length"
    )
    tails = own.join(table.withColumn("taken_key", F.get("base_keys", F.col("taken").cast("int"))), "conv_id").filter("nth > h")
    tails = tails.select(
        "conv_id", (F.col("nth") - F.col("h")).alias("after"), (F.col("taken") + F.col("nth") - F.col("h")).alias("depth"), "key", "before", "taken_key", "dropped_key", "words", "length"
    )

    names = heads.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parents = [], []
            columns = (batch.column(name).to_pylist() for name in ("after", "key", "before", "taken_key", "dropped_key"))
            for after, key, before, taken, dropped in zip(*columns):
                if taken != dropped:  # other first turns: their share of the polynomial is replaced
                    change = _number(taken) - _number(dropped)
                    key, before = _bytes(joined(change, _number(key), after)), _bytes(joined(change, _number(before), after - 1))
                keys.append(key)
                parents.append(before)
            columns = [batch.column("conv_id"), batch.column("depth"), pa.array(keys, pa.binary()), pa.array(parents, pa.binary()), batch.column("words"), batch.column("length")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    tails = in_arrow(tails, run, "conv_id bigint, depth bigint, key binary, parent_key binary, words bigint, length bigint")
    return settled(heads.unionByName(tails))


def nodes(member_rows: DataFrame) -> DataFrame:
    """The distinct prefixes: ``conv_id``, ``depth``, ``key``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``words``, ``weight``.

    A node is named by its smallest member and its depth. ``weight`` is the sum
    of ``n_convs`` over its subtree, which the lengths of its members give.
    """
    grouped = member_rows.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("parent_key").alias("parent_key"),
        F.max("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    grouped = settled(grouped)
    root = grouped.filter("depth = 0").select("conv_id").first()
    top = F.lit(root.conv_id if root else None).cast("bigint")
    parents = grouped.filter("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    deep = grouped.filter("depth > 1").join(parents, ["depth", "parent_key"])
    flat = grouped.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, top))
    linked = settled(flat.unionByName(deep))
    children = linked.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    return settled(linked.drop("parent_key").join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"]))


def centroids(parents: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Subtree sums of each value by centroid decomposition of one tree, parents before children (the top's parent is -1).

    A component is split at its centroid, the deepest node with more than half of
    the component below it. The totals of the parts below make the centroid's sum,
    which is added to the nodes from there to the component's top; the parts and the
    rest are split in turn. No part has more than half of the nodes, so each
    node is visited once per halving.
    """
    sums = [[0] * len(parents) for _ in values]
    place = [-1] * len(parents)  # component of a node, by the number of its last split
    waiting, number = [list(range(len(parents)))], 0
    while waiting:
        component = waiting.pop()
        number += 1
        for v in component:
            place[v] = number
        size = dict.fromkeys(component, 1)
        for v in reversed(component):
            if parents[v] >= 0 and place[parents[v]] == number:
                size[parents[v]] += size[v]
        centroid = [v for v in component if 2 * size[v] > len(component)][-1]  # they are a path from the top
        part = {centroid: centroid}  # of each node below the centroid the child of the centroid above it
        pieces: dict[int, list[int]] = {}
        above: list[int] = []
        for v in component:
            if v == centroid:
                continue
            up = parents[v]
            if up in part:
                part[v] = v if up == centroid else part[up]
                pieces.setdefault(part[v], []).append(v)
            else:
                above.append(v)
        path, v = [centroid], parents[centroid]
        while v >= 0 and place[v] == number:
            path.append(v)
            v = parents[v]
        for own, total in zip(values, sums):
            below = own[centroid] + sum(sum(own[v] for v in piece) for piece in pieces.values())
            for v in path:
                total[v] += below
        waiting.extend(pieces.values())
        if above:
            waiting.append(above)
    return sums


def _small(rows: DataFrame, values: list[str]) -> DataFrame:
    """Sums of components that fit into one task each."""
    done = [f"sum_{name}" for name in values]
    order = ["top_conv_id", "top_depth", "depth", "conv_id"]
    sorted_rows = rows.select(*order, "parent_conv_id", *values, *done).repartition("top_conv_id", "top_depth").sortWithinPartitions(*order)
    fields = ", ".join(["conv_id bigint", "depth bigint", *(f"{name} bigint" for name in done)])

    def close(group: list[tuple]) -> list[list[int]]:
        at = {(row[3], row[2]): i for i, row in enumerate(group)}
        parents = [at.get((row[4], row[2] - 1), -1) for row in group]
        sums = centroids(parents, [tuple(row[5 + i] for row in group) for i in range(len(values))])
        return [[row[3], row[2], *(total[i] + row[5 + len(values) + j] for j, total in enumerate(sums))] for i, row in enumerate(group)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list[list[int]]) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [()] * (2 + len(done))
            return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=["conv_id", "depth", *done])

        group, out = [], []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if group and row[:2] != group[-1][:2]:
                    out += close(group)
                    group = []
                group.append(row)
            if len(out) > PIECE:
                yield batch_of(out)
                out = []
        yield batch_of(out + (close(group) if group else []))

    return in_arrow(sorted_rows, run, fields)


def _beside(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the numbers of their component; a table of checked size is broadcast, a larger one joined by a shuffle."""
    table = settled(table)
    return rows.join(F.broadcast(table) if table.count() <= COMPONENTS else table, keys)


def rollup(tree: DataFrame, ancestors: Callable[[], DataFrame], values: list[str], local: int = LOCAL) -> DataFrame:
    """``conv_id``, ``depth`` and the sum of each value over the node's subtree (``sum_...``).

    Components of the forest of parent edges are split at their centroids, all at
    once, until each weighs at most ``local``; those are finished one by one inside
    tasks. In a component of weight W the nodes with more than W / 2 below them
    are the path from its top to the centroid, the deepest of them. A round
    finds the centroids, tells for every other node whether and below which child
    it hangs from its centroid (``ancestors``: the nodes along each naming conversation), sums up
    these parts, and adds that total along the path. No part weighs more than
    half, so there are about log2(weight / local) rounds.
    """
    comp = ["top_conv_id", "top_depth"]
    top = tree.filter("depth = 0").select("conv_id", "weight").first()
    if top is None:
        return tree.select("conv_id", "depth", *(F.lit(0).cast("bigint").alias(f"sum_{name}") for name in values))
    state = tree.select(
        "conv_id", "depth", "parent_conv_id", "weight", *values, *(F.lit(0).cast("bigint").alias(f"sum_{name}") for name in values),
        F.lit(top.conv_id).cast("bigint").alias(comp[0]), F.lit(0).cast("bigint").alias(comp[1]), F.lit(top.weight).cast("bigint").alias("total"),
    )
    finished: list[DataFrame] = []
    small: list[DataFrame] = []
    above = ancestors() if top.weight > local else None
    heaviest = top.weight
    while heaviest > local:
        small.append(state.filter(F.col("total") <= local))
        state = state.filter(F.col("total") > local)
        heavy = 2 * F.col("weight") > F.col("total")
        chosen = state.filter(heavy).groupBy(*comp).agg(F.max(F.struct("depth", "conv_id", "weight")).alias("c"))
        chosen = chosen.select(*comp, F.col("c.depth").alias("c_depth"), F.col("c.conv_id").alias("c_conv_id"), F.col("c.weight").alias("c_weight"))
        rows = _beside(state, chosen, comp).withColumn("heavy", heavy)
        rows = rows.withColumn("is_centroid", (F.col("depth") == F.col("c_depth")) & (F.col("conv_id") == F.col("c_conv_id")))
        deeper = rows.filter("depth > c_depth").withColumn("along_depth", F.col("c_depth") + 1)
        deeper = deeper.join(above, ["conv_id", "along_depth"], "left")
        below = F.coalesce(F.col("along_parent") == F.col("c_conv_id"), F.lit(False))
        deeper = deeper.select(*rows.columns, below.alias("below"), F.col("along_conv_id").alias("part"))
        rest = rows.filter("depth <= c_depth").select("*", F.lit(False).alias("below"), F.lit(None).cast("bigint").alias("part"))
        rows = settled(deeper.unionByName(rest))
        totals = rows.filter("below or is_centroid").groupBy(*comp).agg(*(F.sum(name).alias(f"add_{name}") for name in values))
        rows = _beside(rows, totals, comp)
        added = [F.when(F.col("heavy"), F.col(f"sum_{name}") + F.col(f"add_{name}")).otherwise(F.col(f"sum_{name}")).alias(f"sum_{name}") for name in values]
        finished.append(rows.filter("is_centroid").select("conv_id", "depth", *added))
        rows = rows.filter("not is_centroid").select(
            "conv_id", "depth", "parent_conv_id", F.when(F.col("heavy"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"), *values, *added,
            F.when(F.col("below"), F.col("part")).otherwise(F.col(comp[0])).alias(comp[0]), F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col(comp[1])).alias(comp[1]),
        )
        weights = settled(rows.groupBy(*comp).agg(F.max("weight").alias("total")))
        state = settled(_beside(rows, weights, comp))
        heaviest = weights.agg(F.max("total")).first()[0] or 0
    small.append(state)
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    result = _small(rows, values)
    for more in finished:
        result = result.unionByName(more)
    return result


def ends(member_rows: DataFrame) -> DataFrame:
    """``depth``, ``key`` and ``ends_sha256`` of the nodes where conversations end.

    The ids are sorted by ranges, so a node where most conversations end is dealt
    out, and joined into pieces of at most ``PIECE`` there; the digest, sequential by its
    nature, then takes the pieces of a node as a stream and holds one at a time.
    """
    rows = member_rows.filter("depth = length").select("key", "depth", "conv_id")
    rows = rows.repartitionByRange("key", "depth", "conv_id").sortWithinPartitions("key", "depth", "conv_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = []
            for key, depth, conv in zip(*(column.to_pylist() for column in batch.columns)):
                if out and out[-1][:2] == [key, depth] and len(out[-1][3]) < PIECE:
                    out[-1][3].append(str(conv))
                else:
                    out.append([key, depth, conv, [str(conv)]])
            columns = [[row[0] for row in out], [row[1] for row in out], [row[2] for row in out], [",".join(row[3]) for row in out]]
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, kinds)], names=["key", "depth", "first", "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)], names=["key", "depth", "ends_sha256"])

        node, running, out = None, None, []
        for batch in batches:
            for key, depth, piece in zip(*(batch.column(name).to_pylist() for name in ("key", "depth", "piece"))):
                if node == (key, depth):
                    running.update(b"," + piece.encode())
                    continue
                if node:
                    out.append((*node, running.hexdigest()))
                node, running = (key, depth), hashlib.sha256(piece.encode())
            yield batch_of(out)
            out = []
        if node:
            yield batch_of([(*node, running.hexdigest())])

    pieces = in_arrow(rows, cut, "key binary, depth bigint, first bigint, piece string")
    pieces = pieces.repartition("key", "depth").sortWithinPartitions("key", "depth", "first")
    return in_arrow(pieces, digest, "key binary, depth bigint, ends_sha256 string")


def build(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node.

    Rows without a ``conv_id`` belong to no conversation. Null roles and texts
    count as empty. A row that occurs twice is two turns. Turns of equal number are in the order
    of the SHA-256 of the length of the role, a colon, the role and the
    text. The base of a negative id is found with the sign of the remainder that SQL gives.
    Without conversations there is no root. Columns: ``conv_id``, ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    member_rows = members(conversations)
    trie = nodes(member_rows)
    tree = trie.select(
        "conv_id", "depth", "parent_conv_id", "weight", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    )

    def ancestors() -> DataFrame:
        names = trie.filter("depth > 0").select("depth", "key", F.col("conv_id").alias("along_conv_id"), F.col("parent_conv_id").alias("along_parent"))
        along = member_rows.filter("depth > 0").select("conv_id", "depth", "key").join(names, ["depth", "key"])
        return settled(along.select("conv_id", F.col("depth").alias("along_depth"), "along_conv_id", "along_parent"))

    sums = rollup(tree, ancestors, ["n_leaves", "saved_tokens"], local)
    none = hashlib.sha256(b"").hexdigest()
    return (
        trie.join(sums, ["conv_id", "depth"])
        .join(ends(member_rows), ["key", "depth"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("sum_n_leaves").alias("n_leaves"), F.col("sum_saved_tokens").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
