import random
from zlib import crc32

import numpy as np
import pytest

pt = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from kinfold.llm import packing  # noqa: E402

PATH = pt.path("word_bpe_49k.json")
ALPHABET = "  \n\t\r\x85 \x1c\0abcXYZÉÈéßÿ×ñ'stllve'ReDLL0123456789.,!?--日本語İΣς🙂́<|endoftext|>abcdeéüß    ,."


def test_ids_equal_the_library():
    rng, library, encoder = random.Random(4), tokenizers.Tokenizer.from_file(PATH), packing.encoder(PATH)
    for i in range(4_000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40)))
        text = text.replace("X", "<|endoftext|>") if i % 7 == 0 else text
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def random_documents(n, longest, seed=0):
    rng = np.random.default_rng(seed)
    return [rng.integers(0, 300, rng.integers(1, longest)).astype(np.uint16) for _ in range(n)]


@pytest.mark.parametrize("n, longest, window", [(1, 5, 64), (200, 40, 64), (50, 400, 64), (1, 1000, 64), (300, 2, 64)])
def test_each_id_lies_in_one_piece(n, longest, window):
    documents = random_documents(n, longest)
    held = {}
    sequences = list(packing.pack(documents, window))
    assert all(sum(length for *_, length in sequence) == window for sequence in sequences[:-1])
    for sequence in sequences:
        for part in packing.without_padding(sequence, window):
            size = sum(length for *_, length in part)
            assert size == window or size & (size - 1) == 0
            for document, start, length in part:
                assert length > 0
                held.setdefault(document, []).append((start, length))
    for document, ids in enumerate(documents):
        at = 0
        for start, length in sorted(held[document]):
            assert start == at
            at += length
        assert at == len(ids)


@pytest.mark.parametrize("dense", [1, 8, 1000])
def test_scores_equal_the_formula_over_all_terms(monkeypatch, dense):
    monkeypatch.setattr(packing, "DENSE", dense)
    documents = random_documents(40, 120, seed=3)
    everything = documents + random_documents(60, 90, seed=4)  # the corpus, of which the index holds a shard
    index = packing.Index(documents, packing.Corpus.of(everything, 300))
    mean = np.mean([len(d) for d in everything])
    holders = {t: sum(t in d for d in everything) for d in documents for t in d.tolist()}
    shared = {t: sum(t in d for d in documents) for d in documents for t in d.tolist()}
    for seed, own in enumerate(documents):
        want = np.zeros(len(documents))
        for term in set(own.tolist()):
            if shared[term] > 1:
                counts = np.array([(d == term).sum() for d in documents])
                longer = 1.2 * (0.25 + 0.75 * np.array([len(d) for d in documents]) / mean)
                want += np.log1p((len(everything) - holders[term] + 0.5) / (holders[term] + 0.5)) * counts * 2.2 / (counts + longer)
        assert index.scores(seed) == pytest.approx(want, rel=1e-4)


def test_terms_after_the_heaviest_find_neighbours():
    # Documents of one id each share the seed's 16 heaviest terms, the last document its other 14.
    seed = np.concatenate([np.repeat(np.arange(16), 20), np.arange(16, 30)]).astype(np.uint16)
    other, alike = np.arange(100, 114, dtype=np.uint16), np.arange(16, 30, dtype=np.uint16)
    holders = [np.full(1, term, np.uint16) for term in range(16)]
    first = next(packing.pack([seed, *holders, other, alike], len(seed) + len(alike)))
    assert [document for document, *_ in first][:2] == [0, 18]


def test_neighbours_come_first():
    one, other = np.arange(1, 20, dtype=np.uint16), np.arange(100, 120, dtype=np.uint16)
    first = next(packing.pack([one, other, other[:15], one[:12]], 40))
    assert [document for document, *_ in first][:2] == [0, 3]


def slow_pack(documents, window):
    """The greedy fill by its definition, all scores worked out pair by pair."""
    n = len(documents)
    mean = sum(map(len, documents)) / n
    holders = {t: sum(t in d.tolist() for d in documents) for d in documents for t in set(d.tolist())}

    def score(seed, other):
        total = 0.0
        for t in set(documents[seed].tolist()):
            tf = int((documents[other] == t).sum())
            if tf and holders[t] > 1:
                total += np.log1p((n - holders[t] + 0.5) / (holders[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(documents[other]) / mean))
        return total

    left = [len(d) for d in documents]
    sequences = []
    while any(left):
        seed = next(i for i in range(n) if left[i])
        sequence, room = [], window

        def take(i):
            nonlocal room
            length = min(left[i], room)
            sequence.append((i, len(documents[i]) - left[i], length))
            left[i] -= length
            room -= length

        take(seed)
        scores = {i: score(seed, i) for i in range(n)}
        while room:
            best = sorted((i for i in range(n) if left[i] and scores[i] > 0), key=lambda i: (-scores[i], i))[: packing.NEIGHBOURS]
            if not best:
                break
            passed = None
            for i in best:
                if left[i] <= room:
                    take(i)
                    if not room:
                        break
                elif passed is None:
                    passed = i
            if room and passed is not None:
                take(passed)
        while room and any(left):
            take(next(i for i in range(n) if left[i]))
        sequences.append(sequence)
    return sequences


@pytest.mark.parametrize("n, longest, window, seed", [(60, 40, 64, 1), (25, 300, 128, 2), (90, 12, 32, 3)])
def test_greedy_fill_equals_its_definition(n, longest, window, seed):
    documents = random_documents(n, longest, seed)
    assert list(packing.pack(documents, window)) == slow_pack(documents, window)


def packed(docs):
    return sorted(tuple(row) for row in packing.pack_documents(docs, PATH).collect())


def some_texts(spark, n):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in range(n)]
    texts += [texts[3]] * 30 + [texts[5] + " end"] * 5
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_rows_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 3_000)
    docs = some_texts(spark, 200)
    one = packed(docs.coalesce(1))
    assert one == packed(docs.repartition(8))
    assert len({row[5] >> 24 for row in one}) > 3  # several shards


def test_statistics_are_those_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 3_000)
    docs = some_texts(spark, 60).repartition(5)
    library = tokenizers.Tokenizer.from_file(PATH)
    ids = [[*library.encode(row.text, add_special_tokens=False).ids, 2] for row in docs.collect()]
    documents, corpus = packing.encoded(docs, PATH)
    assert documents.count() == len(ids)
    assert corpus.documents == len(ids) and corpus.mean == pytest.approx(np.mean([len(own) for own in ids]))
    for term in {1, 2, 320, ids[0][0], ids[7][3]}:
        assert corpus.holders[term] == sum(term in own for own in ids)


def test_one_shard_packs_as_the_whole_corpus(spark):
    """Where all documents fit one shard, the neighbours are those of brute force over the whole table."""
    docs = some_texts(spark, 60)
    library = tokenizers.Tokenizer.from_file(PATH)
    held = [(row.doc_id, np.array([*library.encode(row.text, add_special_tokens=False).ids, 2], np.uint16)) for row in docs.collect()]
    order = [row.doc_id for row in packing.encoded(docs, PATH)[0].orderBy("close", "doc_id").collect()]
    by_id = dict(held)
    want = [
        sorted((order[i], start, length) for i, start, length in part)
        for sequence in slow_pack([by_id[i] for i in order], packing.WINDOW)
        for part in packing.without_padding(sequence)
    ]
    got = {}
    for row in packing.pack_documents(docs, PATH).collect():
        got.setdefault(row.sequence_id, []).append((row.doc_id, row.start, row.length))
    assert sorted(sorted(part) for part in got.values()) == sorted(want)


def test_documents(spark, messy, no_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 50)
    rows = packing.pack_documents(messy, PATH).collect()
    library = tokenizers.Tokenizer.from_file(PATH)
    want = {}
    for row in messy.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 2]
        want.setdefault(row.doc_id, []).append(np.array(ids, "<u4"))
    assert sum(row.length for row in rows) == sum(len(ids) for own in want.values() for ids in own)
    for row in rows:  # each piece is the stated part of one of its document's texts
        own = [ids for ids in want[row.doc_id] if len(ids) == row.doc_tokens]
        assert any(crc32(ids[row.start : row.start + row.length].tobytes()) == row.ids_crc32 for ids in own)
    places = {}
    for row in rows:
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)
    assert packing.pack_documents(no_docs, PATH).collect() == []


def test_many_repeats_of_one_row_stay_in_bounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 100)
    docs = spark.createDataFrame([(1, "one two three four")] * 300, "doc_id bigint, text string")
    rows = packing.pack_documents(docs, PATH).collect()
    assert sum(row.length for row in rows) == 300 * rows[0].doc_tokens
    assert len({row.sequence_id for row in rows}) > 1
