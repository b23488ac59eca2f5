import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from kinfold.llm import prefix_trie

FIELDS = "conv_id bigint, turn bigint, role string, text string, depth int, key string, weight double"


def brute(rows):
    """The contract, node by node, over whole sequences."""
    original = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            pair = (role or "", text or "")
            mark = hashlib.sha256(f"{len(pair[0])}:{pair[0]}{pair[1]}".encode()).hexdigest()
            original.setdefault(conv, []).append(((turn is not None, turn or 0, mark), pair))
    original = {conv: [pair for _, pair in sorted(found)] for conv, found in original.items()}
    members, ended = {}, {}
    for conv in sorted(original):
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        rebuilt = tuple(original.get(base, [])[:h] + original[conv][h:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append(conv)
        ended.setdefault(rebuilt, []).append(conv)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    own = {p: (len(m) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0) for p, m in members.items()}
    sums = {}
    for prefix in sorted(members, key=len, reverse=True):
        below = [sums[child] for child in children.get(prefix, [])]
        sums[prefix] = (sum(b[0] for b in below) if below else 1, own[prefix] + sum(b[1] for b in below))
    return sorted(
        (
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children.get(p, [])), *sums[p],
            hashlib.sha256(",".join(map(str, ended.get(p, []))).encode()).hexdigest(),
        )
        for p in members
    )


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*row, 7, "k", 0.5) for row in rows], FIELDS).repartition(parts)


def result(spark, rows, **settings):
    return sorted((tuple(row) for row in prefix_trie.build(frame(spark, rows), **settings).collect()), key=lambda row: row[:2])


def some_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        copied = rng.random() < 0.3
        for turn in range(4 if copied else rng.randint(1, 7)):
            rows.append((conv, turn, "user" if turn % 2 else "assistant", f"same {turn} words here" if copied else rng.choice(["a b", "c d e", "é  f\n", ""]) + str(rng.randint(0, 2))))
    return rows


def test_equals_brute_force_when_components_are_split_in_rounds(spark):
    rows = some_rows(3)
    assert result(spark, rows, local=25) == brute(rows)


def test_messy_rows(spark):
    rows = some_rows(5)[:60]
    rows += [(None, 1, "user", "lost"), (100, None, None, None), (100, None, "user", "x"), (100, 0, "user", "y"), (100, 0, "user", "y"), (100, 0, "", "y")]
    rows += [(101, 5, "r", "w " * 20_000), (101, -3, "r", None), (-7, 1, "q", "z"), (-7, 2, "q", "z z"), (-7, 3, "q", "z z"), (-7, 4, "q", "v"), (-20, 1, "q", "m"), (2_000_019, 1, "u", "t")]
    rows += [(100, 0, "user", "1:y"), (100, 0, "user1", ":y")]
    assert result(spark, rows) == brute(rows)


@pytest.fixture
def apart(spark):
    """Small partitions are not merged."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_conversation_and_one_row_with_most_of_the_rows(spark, apart):
    rows = [(40, turn // 2, "user", f"t{turn % 5}") for turn in range(120)] + [(41, 3, "user", "again")] * 90
    rows += [(conv, turn, "user", f"t{turn}") for conv in range(42, 50) for turn in range(5)]
    ordered = prefix_trie.turns(frame(spark, rows))
    held = [row.n for row in ordered.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(held) < 0.6 * len(rows)  # 4 partitions
    assert result(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert result(spark, []) == [] and result(spark, [(None, 1, "a", "b")]) == []
    rows = [(3, 1, "user", "one two")]  # its first turns are those of an absent conversation
    assert result(spark, rows) == brute(rows)


def test_many_ends_in_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(20 * conv, 0, "user", "hello") for conv in range(150)] + [(20 * conv + 1, 9, "user", "more") for conv in range(20)]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_decomposition_of_any_tree(seed):
    rng = random.Random(seed)
    n = [1, 2, 60, 300][seed]
    parents = [-1] + [rng.randint(max(0, i - rng.choice([1, 5, 300])), i - 1) for i in range(1, n)]
    values = [tuple(rng.randint(-5, 9) for _ in range(n)) for _ in range(2)]
    want = [list(value) for value in values]
    for v in range(n - 1, 0, -1):
        for total in want:
            total[parents[v]] += total[v]
    assert prefix_trie.centroids(parents, values) == want
