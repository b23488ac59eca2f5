import numpy as np
import pytest
import xxhash

from kinfold.llm import simhash
from kinfold.llm.components import connected_components


def slow_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if hashes and 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(fps, budget=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= budget:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def balls(seed, n=25, size=30):
    rng = np.random.default_rng(seed)
    found = {0}
    for centre in rng.integers(0, 1 << 63, n):
        for _ in range(rng.integers(1, size)):
            value = int(centre)
            for bit in rng.integers(0, 64, rng.integers(0, 6)):
                value ^= 1 << int(bit)
            found.add(value)
    return sorted(found)


@pytest.mark.parametrize("wide", [100_000, 15])
def test_trie_join_equals_all_pairs(spark, monkeypatch, wide):
    monkeypatch.setattr(simhash, "WIDE", wide)
    fps = balls(3)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    links = simhash.trie_links(spark.createDataFrame([(fp,) for fp in signed], "fp bigint"))
    found = {row.node: row.component for row in connected_components(links).collect()}
    got, want = {}, {}
    for place, (fp, root) in enumerate(zip(signed, components(fps))):
        got.setdefault(found.get(fp, fp), set()).add(place)
        want.setdefault(root, set()).add(place)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_dense_trie_in_steps(monkeypatch):
    monkeypatch.setattr(simhash, "STEP", 50)
    rng = np.random.default_rng(1)
    keys = np.unique([sum(1 << int(bit) for bit in rng.integers(0, 48, 4)) for _ in range(400)]).astype(np.uint64)
    got = simhash.join_tries(keys, np.array([[0, len(keys), 0, len(keys), 0, 47]]))
    assert got.tolist() == components([int(key) for key in keys])


def test_groups_over_several_chunks(spark, monkeypatch):
    fps = balls(9)
    monkeypatch.setattr(simhash, "CHUNK", 10)
    keys = [(16, 7, -1, -1, fp & simhash.LOW, place) for place, fp in enumerate(fps[:60])] + [(32, fp & 0xFFF, -1, -1, fp >> 20 & simhash.LOW, fp & simhash.LOW) for fp in fps]
    import pyarrow as pa

    keys.sort()
    table = np.array(keys, np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(table[i : i + 4, c]) for c in range(6)], names=["turns", "node", "one", "other", "low", "fp"]) for i in range(0, len(table), 4)]
    parts = sum(batch.num_rows for batch in simhash._walk(3)(iter(batches)))
    monkeypatch.setattr(simhash, "CHUNK", 10**6)
    assert parts == sum(batch.num_rows for batch in simhash._walk(3)(iter(batches)))


def test_fingerprints_and_components(spark, messy, no_docs):
    rows = simhash.near_duplicates(simhash.fingerprints(messy)).select("doc_id", simhash.hexadecimal().alias("f"), "component_id").collect()
    docs = messy.collect()
    fps = [slow_fingerprint(row.text or "") for row in docs]
    assert sorted((row.doc_id, row.f) for row in rows if row.doc_id) == sorted((row.doc_id, f"{fp:016x}") for row, fp in zip(docs, fps) if row.doc_id)
    ids = {}
    for row, root in zip(docs, components(fps)):
        ids.setdefault(root, []).append(row.doc_id)
    least = {root: min((i for i in group if i is not None), default=None) for root, group in ids.items()}
    want = sorted(((row.doc_id, least[root]) for row, root in zip(docs, components(fps))), key=str)
    assert sorted(((row.doc_id, row.component_id) for row in rows), key=str) == want
    assert simhash.near_duplicates(simhash.fingerprints(no_docs)).collect() == []


def test_one_row_of_each_group_stays(spark, messy, no_docs):
    kept = simhash.drop_near_duplicates(messy)
    assert kept.columns == messy.columns
    docs = messy.collect()
    groups = {}
    for row, root in zip(docs, components([slow_fingerprint(row.text or "") for row in docs])):
        groups.setdefault(root, []).append(row.doc_id)
    want = sorted((min((i for i in group if i is not None), default=None) for group in groups.values()), key=str)
    assert sorted((row.doc_id for row in kept.collect()), key=str) == want
    assert simhash.drop_near_duplicates(no_docs).collect() == []


def test_component_chains(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 300), (7, 7), (None, 4), (300, 100)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(51)} | {100: 100, 200: 100, 300: 100}
