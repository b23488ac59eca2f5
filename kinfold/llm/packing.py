"""Lexical retrieval packing: BM25 neighbours fill each window (operator 5)."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kinfold.llm.batches import SLICE, in_arrow
from kinfold.llm.byte_bpe import show_bytes
from kinfold.llm.components import settled
from kinfold.llm.sums import summed
from kinfold.llm.words import Memory
from kinfold.skew import checked_broadcast

WINDOW = 4_096
END = 2  # the id after each document
SHARD_TOKENS = 1_500_000  # ids that a shard of the index aims at; it is closed when it reaches twice as many
DOCUMENT = 30  # what a document counts beside its ids, which bounds the documents of a shard too
WORDS, PIECES = 2_000_000, 200_000  # words and pieces whose ids a task remembers
DENSE = 8  # a term in more than one of so many documents of a shard has a row of weights
NEIGHBOURS = 64  # fetched at once; more are fetched while there is room
K1, B = 1.2, 0.75

# ASCII and Latin-1 letters: case, composition and pieces of these follow simple rules.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class WordEncoder:
    """Ids of texts by the ``tokenizers`` library. White space never joins words, so results are kept per word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.size = self._tokenizer.get_vocab_size()  # ids below this one
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        self._merge = self._tokenizer.model.tokenize
        self._pieces = Memory(self._encode_piece, PIECES)
        self._words = Memory(self._encode_word, WORDS)

    def _encode_piece(self, piece: str) -> bytes:
        return array(self.kind().dtype.char, [token.id for token in self._merge(show_bytes(piece.encode()))]).tobytes()

    def _encode_word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(map(self._pieces.__getitem__, _PIECE.findall(word.lower())))
        return array(self.kind().dtype.char, self._tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self._joined(text), self.kind)

    def document(self, text: str) -> np.ndarray:
        """The ids of a text and the end id."""
        return np.frombuffer(self._joined(text) + self.kind(END).tobytes(), self.kind)

    def _joined(self, text: str) -> bytes:
        return b"".join(map(self._words.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and file."""
    return WordEncoder(path)


@dataclass(frozen=True)
class Corpus:
    """What BM25 takes from all documents: their number, their mean length, and in how many each id occurs."""

    documents: int
    mean: float
    holders: np.ndarray

    @classmethod
    def of(cls, documents: list[np.ndarray], ids: int) -> Corpus:
        totals = _totals(documents, ids)
        return cls(int(totals[0]), totals[1] / max(totals[0], 1), totals[2:])

    def rarity(self) -> np.ndarray:
        return np.log1p((self.documents - self.holders + 0.5) / (self.holders + 0.5)).astype(np.float32)


def _totals(documents: list[np.ndarray], ids: int) -> np.ndarray:
    """Documents, their ids, and the documents that hold each id: numbers that add up over any split of the corpus."""
    out = np.zeros(2 + ids)
    out[0], out[1] = len(documents), sum(map(len, documents))
    for own in documents:
        out[2 + np.unique(own).astype(np.int64)] += 1
    return out


class Index:
    """Inverted BM25 index over the documents of one shard, weighed by the whole corpus; token ids are the terms."""

    def __init__(self, documents: list[np.ndarray], corpus: Corpus):
        lengths = np.array([len(ids) for ids in documents], np.int64)
        keys = np.concatenate(documents).astype(np.int64) << 32
        keys |= np.repeat(np.arange(len(documents)), lengths)
        keys.sort()
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(starts, len(keys))).astype(np.float32)
        keys = keys[starts]
        self.document, term = (keys & 0xFFFFFFFF).astype(np.int32), (keys >> 32).astype(np.int32)
        del keys, starts
        self.bounds = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1], [True]]))
        held = np.diff(self.bounds)
        rarity = corpus.rarity()[term[self.bounds[:-1]]]
        longer = (K1 * (1 - B + B * lengths / max(corpus.mean, 1))).astype(np.float32)
        self.weight = np.repeat(rarity, held) * counts * np.float32(K1 + 1) / (counts + longer[self.document])
        # The same entries by document, the heaviest first: a seed's terms.
        number = np.repeat(np.arange(len(held), dtype=np.int32), held)
        useful = np.flatnonzero(np.repeat(held > 1, held)).astype(np.int32)
        useful = useful[np.lexsort((-self.weight[useful], self.document[useful]))]
        self.terms = number[useful]
        self.starts = np.searchsorted(self.document[useful], np.arange(len(documents) + 1))
        # Rows of weights of the common terms; no more than DENSE numbers for each entry.
        common = held * DENSE > len(documents)
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        self.rows = np.zeros((int(common.sum()), len(documents)), np.float32)
        inside = np.flatnonzero(common[number])
        self.rows[self.row[number[inside]], self.document[inside]] = self.weight[inside]

    def _add(self, found: np.ndarray, terms: np.ndarray) -> np.ndarray:
        for low, high in zip(self.bounds[terms].tolist(), self.bounds[terms + 1].tolist()):
            found[self.document[low:high]] += self.weight[low:high]
        return found

    def scores(self, seed: int) -> np.ndarray:
        """BM25 scores of all documents of the shard against all terms of the seed."""
        terms = self.terms[self.starts[seed] : self.starts[seed + 1]]
        row = self.row[terms]
        asked = np.zeros(len(self.rows), np.float32)
        asked[row[row >= 0]] = 1
        return self._add(asked @ self.rows, terms[row < 0])


def pack(documents: list[np.ndarray], window: int = WINDOW, corpus: Corpus | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold each id once.

    The next unused document is the seed. Its neighbours follow by falling score,
    those that fit whole first; what room is left takes the start of the best one
    that did not fit, whose rest stays unused. Without neighbours the next unused
    documents follow. Only the last sequence can be short. ``corpus`` gives the
    weights of the terms; without one they are those of ``documents``.
    """
    corpus = corpus or Corpus.of(documents, int(max(map(np.max, documents))) + 1)
    index = Index(documents, corpus)
    left = np.array([len(ids) for ids in documents], np.int64)
    total = left.copy()
    following = 0
    while True:
        while following < len(left) and not left[following]:
            following += 1
        if following == len(left):
            return
        seed = following
        sequence: list[tuple[int, int, int]] = []
        room = window

        def take(document: int) -> None:
            nonlocal room
            length = int(min(left[document], room))
            sequence.append((document, int(total[document] - left[document]), length))
            left[document] -= length
            room -= length

        take(seed)
        scores = index.scores(seed) if room else None
        while room:
            scores[left == 0] = 0
            best = np.argpartition(-scores, NEIGHBOURS)[:NEIGHBOURS] if len(scores) > NEIGHBOURS else np.arange(len(scores))
            best = best[scores[best] > 0]
            best = best[np.lexsort((best, -scores[best]))]
            if not len(best):
                break
            passed = None
            for document in best.tolist():
                if left[document] <= room:
                    take(document)
                    if not room:
                        break
                elif passed is None:
                    passed = document
            if room and passed is not None:
                take(passed)
        while room:
            while following < len(left) and not left[following]:
                following += 1
            if following == len(left):
                break
            take(following)
        yield sequence


def without_padding(sequence: list[tuple[int, int, int]], window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """A short sequence cut into sequences of falling powers of two, which need no padding; a full one as it is."""
    size = sum(length for *_, length in sequence)
    if size == window:
        yield sequence
        return
    pieces = list(reversed(sequence))
    while size:
        room = 1 << (size.bit_length() - 1)
        size -= room
        part = []
        while room:
            document, start, length = pieces.pop()
            if length > room:
                pieces.append((document, start + room, length - room))
                length = room
            part.append((document, start, length))
            room -= length
        yield part


FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _marks(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, count, dtype=np.uint32)


def likeness(ids: np.ndarray, different: np.ndarray, marks: np.ndarray) -> tuple[int, int]:
    """The smallest mark of an id and the smallest mark of two neighbouring ids: equal for documents alike, roughly and closely."""
    own = marks[ids]
    return int(marks[different].min()), int((own[:-1] * np.uint32(0x9E3779B1) ^ own[1:]).min()) if len(own) > 1 else 0


def encoded(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, Corpus]:
    """All documents, ``doc_id``, ``ids`` (16 or 32 bits each, with the end id), ``n`` and marks of likeness, in the
    checkpoint folder, and the statistics over them.

    One pass over the texts does both: each task ends with a row of its totals
    (marked by a negative ``n``), and these are summed over partitions.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), value.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "ids", "n", "rough", "close"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        marks = _marks(encode.size, 11)
        totals = np.zeros(2 + encode.size)
        holders = totals[2:]
        there = np.zeros(encode.size, bool)  # ids of the text in hand
        owner = None
        for batch in batches:
            owner = batch.column("doc_id").type
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found, alike = [], []
                for value in part.column("text").to_pylist():
                    ids = encode.document(value)
                    there[ids] = True
                    different = np.flatnonzero(there)
                    there[different] = False
                    holders[different] += 1
                    alike.append(likeness(ids, different, marks))
                    found.append(ids)
                sizes = list(map(len, found))
                totals[0] += len(found)
                totals[1] += sum(sizes)
                numbers = (sizes, [one for one, _ in alike], [two for _, two in alike])
                columns = [part.column("doc_id"), pa.array([ids.tobytes() for ids in found], pa.binary()), *(pa.array(column, pa.int64()) for column in numbers)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if owner is not None:
            last = [pa.nulls(1, owner), pa.array([totals.tobytes()], pa.binary()), *(pa.array([number], pa.int64()) for number in (-1, 0, 0))]
            yield pa.RecordBatch.from_arrays(last, names=names)

    every = settled(in_arrow(rows, run, f"doc_id {kind}, ids binary, n bigint, rough bigint, close bigint"))
    add = lambda batch: sum(np.frombuffer(totals.as_py()) for totals in batch.column("ids"))
    size = encoder(path).size
    totals = summed(every.filter("n < 0").select("ids"), add, 2 + size)
    return every.filter("n >= 0"), Corpus(int(totals[0]), totals[1] / max(totals[0], 1), totals[2:])


def sharded(documents: DataFrame, size: float) -> DataFrame:
    """``documents`` with ``shard``, a number per shard of about ``SHARD_TOKENS`` ids.

    Shards follow from the rows alone, not from partitions: documents that are roughly
    alike share a bucket; a bucket beyond a shard is parted by close likeness, and
    what is still beyond one (copies) by a hash of the row. Sizes come from
    two aggregates over narrow columns; the buckets that are parted are a few numbers
    each, broadcast after a count of them.
    """
    buckets = 1 << max(int(size / SHARD_TOKENS), 0).bit_length()
    rows = documents.withColumn("bucket", F.pmod(F.xxhash64("rough"), F.lit(buckets)))
    parts = F.ceil(F.sum(F.col("n") + DOCUMENT) / SHARD_TOKENS)
    wide = checked_broadcast(rows.groupBy("bucket").agg(parts.alias("wide")).filter("wide > 1"), settle=True)
    rows = rows.join(wide, "bucket", "left").withColumn("part", F.pmod(F.xxhash64("close"), F.coalesce("wide", F.lit(1)))).drop("wide")
    deep = checked_broadcast(rows.groupBy("bucket", "part").agg(parts.alias("deep")).filter("deep > 1"), settle=True)
    rows = rows.join(deep, ["bucket", "part"], "left")
    spread = F.pmod(F.xxhash64("doc_id", "ids"), F.coalesce("deep", F.lit(1)))
    shard = (F.col("bucket") * (1 << 12) + F.least("part", F.lit((1 << 12) - 1))) * (1 << 12) + F.least(spread, F.lit((1 << 12) - 1))
    return rows.select(*documents.columns, shard.alias("shard"))


def pack_documents(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` per piece.

    A null text counts as empty; such a document is its end id alone. Repeated
    rows are documents of their own. Each text is encoded once; BM25 weights come from
    all documents. The index is sharded: each task holds one shard at a
    time, its ids, its index and its sequences, and a shard closes early at
    twice its size, as with many repeats of one row. Rows are the same for any number of partitions.
    """
    documents, corpus = encoded(docs, path, text, doc_id)
    order = ["shard", "close", "doc_id", "ids"]
    ordered = sharded(documents, corpus.documents * (corpus.mean + DOCUMENT)).select("doc_id", "ids", "shard", "close")
    ordered = ordered.repartition("shard").sortWithinPartitions(*order).select("doc_id", "ids", "shard")
    schema = StructType([documents.schema["doc_id"]] + [StructField(name, LongType()) for name in FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(path).kind
        sequences = 0

        def close(shard: int, owners: list, held: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal sequences
            out: list[list[int]] = [[] for _ in range(1 + len(FIELDS))]
            for packed in pack(held, corpus=corpus):
                for sequence in without_padding(packed):
                    offset = 0
                    for document, start, length in sequence:
                        ids = held[document][start : start + length].astype("<u4").tobytes()
                        values = (document, start, length, crc32(ids), len(held[document]), (shard << 24) + sequences, offset)
                        for column, number in zip(out, values):
                            column.append(number)
                        offset += length
                    sequences += 1
            names = pa.concat_arrays(owners)
            columns = [names.take(pa.array(out[0], pa.int64())), *(pa.array(column, pa.int64()) for column in out[1:])]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        shard, owners, held, tokens = None, [], [], 0
        for batch in batches:
            marks = batch.column("shard").to_numpy()
            for place, (mark, ids) in enumerate(zip(marks.tolist(), batch.column("ids"))):
                if held and (mark != shard or tokens >= 2 * SHARD_TOKENS):
                    yield close(shard, owners, held)
                    owners, held, tokens = [], [], 0
                if mark != shard:
                    shard, sequences = mark, 0
                owners.append(batch.column("doc_id").slice(place, 1))
                held.append(np.frombuffer(ids.as_py(), kind))
                tokens += len(held[-1]) + DOCUMENT
        if held:
            yield close(shard, owners, held)

    return in_arrow(ordered, run, schema)
