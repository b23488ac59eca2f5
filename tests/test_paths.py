import random
from itertools import product

import pytest
from graphs import graph, rows

from kinfold.operators import paths

LABELS = ["A", "B", "C", "D"]


def some_graph(spark, seed):
    rng = random.Random(seed)
    nodes = [(i, rng.sample(LABELS, rng.choice([1, 1, 2])), {}) for i in range(16)]
    edges = [(rng.randint(0, 15), rng.choice(["R", "S"]), rng.randint(0, 15)) for _ in range(40)]
    return nodes, edges, graph(spark, nodes, edges)


def steps(nodes, edges, first, second):
    bears = dict((i, labels) for i, labels, _ in nodes)
    found = []
    for a, _, b in edges:
        pairs = [(a, b)] if a == b else [(a, b), (b, a)]
        found += [(x, y) for x, y in pairs if first in bears[x] and second in bears[y]]
    return found


@pytest.mark.parametrize("seed, labels", [(1, "AB"), (2, "ABC"), (3, "ABCD"), (4, "ABA")])
def test_equals_all_combinations(spark, seed, labels):
    nodes, edges, g = some_graph(spark, seed)
    hops = [steps(nodes, edges, *pair) for pair in zip(labels, labels[1:])]
    want = sorted(
        (*[step[0] for step in chosen], chosen[-1][1]) for chosen in product(*hops) if all(x[1] == y[0] for x, y in zip(chosen, chosen[1:]))
    )
    assert rows(paths.paths(g, labels)) == want and want
    # What a join reads lies on a complete path.
    for place, step in enumerate(paths.reduced_hops(g, labels)):
        assert set(rows(step)) == {(path[place], path[place + 1]) for path in want}


def test_no_path(spark):
    _, _, g = some_graph(spark, 5)
    assert rows(paths.paths(g, ["A", "Z", "B"])) == [] and paths.paths(g, ["A", "Z", "B"]).columns == ["n0", "n1", "n2"]
    with pytest.raises(ValueError):
        paths.paths(g, ["A"])
