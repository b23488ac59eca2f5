import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import embed_dedup, topk

FIELDS = "vec_id bigint, embedding array<float>, label int, cell int, score bigint, key string"


def rows_of(seed, n=150, size=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    rows = []
    for i in range(n):
        vector = centres[rng.integers(12)] + rng.normal(size=size) * rng.choice([0.01, 0.08, 0.5])
        rows.append([i, (vector * rng.choice([1e-3, 1, 1e3])).astype(np.float32).tolist(), int(rng.integers(3)), 1, 2, "k"])
    nan, inf = float("nan"), float("inf")
    rows += [[n, rows[0][1], rows[0][2]], [n + 1, rows[0][1], None], [n + 2, None, 0], [n + 3, [0.0] * size, 0], [n + 4, [nan] * size, 0]]
    rows += [[n + 5, [None] + [1.0] * (size - 1), 0], [n + 6, [inf] * size, 0], [n + 7, [], 0], [n + 8, [1.0, 2.0], 0], [n + 9, [2.0, 4.0], 0]]
    rows += [[None, rows[1][1], rows[1][2]], [5, rows[5][1], rows[5][2]], [100, [3e38, 3e38, -3e38] + [0.0] * (size - 3), 1], [200, [1e-40] * size, 1]]
    return [(row + [1, 2, "k"])[:6] for row in rows]


def ok(vector):
    return vector is not None and len(vector) > 0 and all(x is not None and np.isfinite(x) for x in vector)


def slow_links(rows, threshold=0.98):
    unit = {}
    for place, (_, vector, label, *_) in enumerate(rows):
        if ok(vector) and label is not None and any(vector):
            v = np.array(np.float32(vector), float)
            unit[place] = v / np.abs(v).max()
            unit[place] /= np.linalg.norm(unit[place])
    links = [set() for _ in rows]
    for a in unit:
        for b in unit:
            if a != b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a].add(b)
    return links


@pytest.mark.parametrize("resident, per_pivot, tile", [(4096, 50_000, 1024), (7, 20, 5)])
def test_links_and_components_equal_all_pairs(spark, monkeypatch, resident, per_pivot, tile):
    monkeypatch.setattr(embed_dedup, "PER_PIVOT", per_pivot)
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    monkeypatch.setattr(embed_dedup.link_rows, "__defaults__", (0.98, resident))
    rows = rows_of(4)
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, FIELDS)).collect()
    links = slow_links(rows)
    component = {}
    for start in range(len(rows)):
        if start not in component:
            stack, group = [start], {start}
            while stack:
                for other in links[stack.pop()] - group:
                    group.add(other)
                    stack.append(other)
            least = min((rows[i][0] for i in group if rows[i][0] is not None), default=None)
            component |= dict.fromkeys(group, least)
    want = [(row[0], len(links[i]), component[i], row[0] is not None and component[i] == row[0]) for i, row in enumerate(rows)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(8)
    units = embed_dedup.unit(np.repeat(rng.normal(size=(20, 64)), 20, axis=0) + rng.normal(size=(400, 64)) * 0.12)
    whole = embed_dedup.Quantised(units)
    x, y = embed_dedup.possible_pairs(whole, whole, 0.98)
    exact = units @ units.T >= 0.98
    possible = np.zeros_like(exact)
    possible[x, y] = True
    assert (possible | ~exact).all() and 400 < exact.sum() < possible.sum() < 20_000


def test_no_vectors(spark):
    none = spark.createDataFrame([], FIELDS)
    assert embed_dedup.near_duplicates(none).collect() == []
    assert topk.search(none, F.col("vec_id") % 10 == 0).collect() == []


def slow_top(rows, k, every):
    found = []
    vectors = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows if ok(v) and i is not None]
    for query in {(i, tuple(q)) for i, q in vectors if i % every == 0}:
        scores = [(-sum(a * b for a, b in zip(query[1], v)), i) for i, v in vectors if i != query[0] and len(v) == len(query[1])]
        found += [(query[0], rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("changes", [{}, {"QUERIES": 3, "BLOCK": 40, "PER_PIVOT": 2, "STEP": 7}])
def test_top_rows_equal_all_scores(spark, monkeypatch, changes):
    for name, value in changes.items():
        monkeypatch.setattr(topk, name, value)
    rows = [row for row in rows_of(6) if not (row[0] == 100 and ok(row[1]) and max(row[1]) > 1e30)] + [(i, [0.5] * 8, 1, 1, 2, "k") for i in range(300, 330)]
    got = topk.search(spark.createDataFrame(rows, FIELDS), F.col("vec_id") % 10 == 0).collect()
    # An id with several rows shares its best; leave such queries out of the comparison.
    ids = [row[0] for row in rows]
    single = {i for i in ids if ids.count(i) == 1}
    assert sorted(tuple(row) for row in got if row.query_id in single) == [row for row in slow_top(rows, 10, 10) if row[0] in single]


@pytest.mark.parametrize("pivots", [1, 8, 256])
@pytest.mark.parametrize("copies", [11, 25])
def test_a_query_id_with_many_rows_finds_all(spark, monkeypatch, pivots, copies):
    monkeypatch.setattr(topk, "LEAST_PIVOTS", pivots)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist(), 1, 1, 2, "k") for i in range(1, 60)]
    rows += [(100, [4.0] * 8, 1, 1, 2, "k")] * copies + [(200, (np.eye(8)[i % 8] * 3).tolist(), 1, 1, 2, "k") for i in range(copies)]
    got = topk.search(spark.createDataFrame(rows, FIELDS), F.col("vec_id") % 100 == 0).collect()
    want = []
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows]
    for query in (100, 200):
        pairs = [(-sum(a * b for a, b in zip(q, v)), i) for own, q in whole if own == query for i, v in whole if i != query]
        want += [(query, rank, i, -score) for rank, (score, i) in enumerate(sorted(pairs)[:10], 1)]
    assert sorted(map(tuple, got)) == want


def test_bounds_prune_far_groups(spark):
    rng = np.random.default_rng(3)
    groups = [np.eye(8)[i] * 5 + rng.normal(size=(40, 8)) * 0.01 for i in range(8)]
    rows = [(i, v.tolist(), 1, 1, 2, "k") for i, v in enumerate(np.concatenate(groups))]
    got = topk.search(spark.createDataFrame(rows, FIELDS), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == slow_top(rows, 10, 10)


def test_scores_beyond_double_precision_are_exact():
    queries, rows = np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0], [2.0**60, 0.0]])
    assert topk.products(queries, rows).tolist() == [[2**60 + 1, 2**63 - 1]]


def dealt_copies(monkeypatch, module, run):
    """Rows that reach the jobs of ``module``, resident and visiting."""
    met = []

    def counting(frame, work, schema):
        if "visitor" in frame.columns:
            met.append(frame.count())
        return real(frame, work, schema)

    real = module.in_arrow
    monkeypatch.setattr(module, "in_arrow", counting)
    run().collect()
    return met[0]


def test_few_queries_share_a_bundle(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist(), 1, 1, 2, "k") for i in range(600)]
    frame = spark.createDataFrame(rows, FIELDS)
    # 8 pivots, no bound that prunes: each row goes to one bundle, and so does each of the 60 queries.
    assert dealt_copies(monkeypatch, topk, lambda: topk.search(frame, F.col("vec_id") % 10 == 0)) <= 660


def test_bundles_hold_neighbours_and_a_bounded_number_of_queries(monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 10)
    centre = np.array([[0.0], [100.0], [1.0], [101.0], [2.0]])
    bundle = topk.bundled(centre, np.array([4, 30, 4, 9, 4]))
    assert bundle[0] == bundle[2] and len(set(bundle[[0, 1, 3, 4]].tolist())) == 4


@pytest.mark.parametrize("resident", [100, 130, 200, 1000])
def test_blocks_of_a_cell_meet_once(spark, monkeypatch, resident):
    monkeypatch.setattr(embed_dedup.link_rows, "__defaults__", (0.98, resident))
    rng = np.random.default_rng(6)
    frame = spark.createDataFrame([(i, rng.normal(size=8).tolist(), 1, 1, 2, "k") for i in range(600)], FIELDS)
    blocks = -(-600 // resident)
    assert dealt_copies(monkeypatch, embed_dedup, lambda: embed_dedup.near_duplicates(frame)) <= 600 * (1 + blocks / 2)
