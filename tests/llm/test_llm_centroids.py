import hashlib

import numpy as np
import pytest

from kinfold.llm import centroids

FIELDS = "vec_id bigint, embedding array<float>, id string, cluster int, near string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 1, None) for i, v in vectors], FIELDS)


def plain(vectors, clusters, rounds, width):
    """Lloyd rounds in Python integers, every distance worked out."""
    kept = [(i, v) for i, v in vectors if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    points = [[int(np.floor(1024 * float(np.float32(x)))) for x in v] for _, v in kept]
    named = [(hashlib.sha256(f"3:{i}".encode()).hexdigest(), p) for (i, _), p in zip(kept, points) if i is not None]
    centers = [p for _, p in sorted(named)[:clusters]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        owner = [nearest(p)[1] for p in points]
        for j in range(len(centers)):
            own = [p for p, o in zip(points, owner) if o == j]
            if own:
                centers[j] = [sum(column) // len(own) for column in zip(*own)]
    found = [nearest(p) for p in points]
    total = sum(d for d, _ in found)
    rows = []
    for (i, _), (d, j) in zip(kept, found):
        digest = hashlib.sha256(",".join(map(str, centers[j])).encode()).hexdigest()
        rows.append((i, j, d, sum(e for e, o in found if o == j), total, digest))
    return sorted(rows, key=repr)


def result(spark, vectors, **settings):
    rows = centroids.cluster(frame(spark, vectors), **settings).collect()
    return sorted((tuple(row) for row in rows), key=repr)


@pytest.mark.parametrize("n, width, clusters, rounds", [(300, 64, 8, 10), (5, 4, 8, 1)])
def test_equals_plain_rounds(spark, monkeypatch, n, width, clusters, rounds):
    monkeypatch.setattr(centroids, "BLOCK", 64)
    rng = np.random.default_rng(n)
    vectors = [(i * 7, rng.normal(0, 0.2, width).tolist()) for i in range(n)]
    settings = dict(clusters=clusters, rounds=rounds, width=width)
    assert result(spark, vectors, **settings) == plain(vectors, **settings)


def test_ties_repeats_nulls_and_extremes(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [4.0, 0.0]), (None, [9.0, -9.0]), (None, None)]
    vectors += [(4, None), (5, [1.0]), (6, []), (7, [1.0, None]), (8, [nan, 1.0]), (9, [1.0, inf]), (10, [1.0, -inf]), (11, [1.0, 2.0, 3.0])]
    vectors += [(20 + i, [float(i % 5), 1.0]) for i in range(20)] + [(60, [100_000.0, -100_000.0])]
    for clusters in (3, 40):
        settings = dict(clusters=clusters, rounds=2, width=2)
        assert result(spark, vectors, **settings) == plain(vectors, **settings)


def test_empty_table_and_no_ids(spark):
    assert result(spark, []) == []
    assert result(spark, [(None, [1.0] * 64)]) == []
    assert centroids.cluster(frame(spark, [])).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_a_component_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="do not fit a long"):
        result(spark, [(1, [1e9, 0.0])], width=2)


def test_bounds_save_distances_and_lose_nothing():
    rng = np.random.default_rng(1)
    middles = rng.normal(0, 300, (6, 16))
    points = (middles[rng.integers(0, 6, 3_000)] + rng.normal(0, 40, (3_000, 16))).astype(np.int32)
    history = [points[:6].astype(np.int64)]
    state = centroids.Bounds.fresh(points, 6)
    work = []
    for _ in range(12):
        work.append(state.advance(history))
        exact = ((points[:, None].astype(np.int64) - history[-1]) ** 2).sum(2)
        assert (state.owner == exact.argmin(1)).all()
        sums = state.totals()
        assert (sums[:, 1:] == [points[state.owner == j].sum(0) for j in range(6)]).all()
        history.append(np.array([s[1:] // s[0] if s[0] else c for s, c in zip(sums, history[-1])]))
    assert work[0] >= 3_000 * 6 and sum(work[1:]) < 0.4 * 3_000 * 6 * 11


def test_total_displacement_not_the_sum_of_steps():
    # A centroid that goes out and comes back leaves the bounds as they were.
    points = np.array([[0], [10]], np.int16)
    there, away = np.array([[0], [10]]), np.array([[4], [10]])
    state = centroids.Bounds.fresh(points, 2)
    state.advance([there])
    assert state.advance([there, away]) == 0
    assert state.advance([there, away, there]) == 0 and state.owner.tolist() == [0, 1]
