"""Byte-level BPE: encoding with offsets, and decoding (operator 1).

The ``tokenizers`` library does the merges over Arrow batches. Its byte-level
model works on strings in which each byte is one printable character; the
mapping is a rule over the 256 bytes (``byte_characters``).
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from kinfold.llm.batches import in_arrow, per_text
from kinfold.llm.words import Memory, latin_pieces, spaced_words


@lru_cache(maxsize=1)
def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


@lru_cache(maxsize=1)
def _shown() -> dict[int, str]:
    return dict(byte_characters())


def show_bytes(token: bytes) -> str:
    """One printable character per byte."""
    return token.decode("latin-1").translate(_shown())


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        vocabulary = {show_bytes(token): rank for token, rank in ranks.items()}
        # A rank stands for every split of its token into two tokens, so each split is a merge of that priority.
        merges = [
            (show_bytes(token[:cut]), show_bytes(token[cut:]))
            for token, _ in sorted(ranks.items(), key=lambda item: item[1])
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        # ignore_merges: a whole piece that is a token needs no merges.
        self._tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self._tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self._merge = self._tokenizer.model.tokenize
        byte_of = {character: byte for byte, character in byte_characters().items()}
        self._bytes = {rank: bytes(map(byte_of.__getitem__, token)) for token, rank in vocabulary.items()}
        self._decoded = _Strings(self._bytes)
        self._decimals = _Strings({rank: b"%d " % rank for rank in vocabulary.values()})
        self._words = Memory(self._encode_word)

    def _encode_word(self, word: str) -> bytes:
        pieces = latin_pieces(word)
        if pieces is None:
            ids = self._tokenizer.encode(word, add_special_tokens=False).ids
        else:
            ids = [token.id for piece in pieces for token in self._merge(show_bytes(piece.encode()))]
        return np.array(ids, np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self._words.__getitem__, spaced_words(text))), np.int32)

    def encode_with_offsets(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids with their first and end code point. A token inside a character has that whole character's place."""
        ids, starts, ends, place = [], [], [], 0
        for word in spaced_words(text):
            found = self._tokenizer.encode(word, add_special_tokens=False)
            ids += found.ids
            starts += [place + start for start, _ in found.offsets]
            ends += [place + end for _, end in found.offsets]
            place += len(word)
        return ids, starts, ends

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(self._decoded.joined(np.asarray(ids, np.int32)))

    def decode_pieces(self, ids: list[int]) -> list[str]:
        """Text per id. A character split over ids comes with the id that completes it; broken bytes become U+FFFD."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        last = len(ids) - 1
        return [reader.decode(self._bytes[i], final=place == last) for place, i in enumerate(ids)]

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as decimals joined by spaces, SHA-256 of the bytes they decode to."""
        ids = self.encode(text)
        listed, decoded = hashlib.sha256(), hashlib.sha256()
        previous = b""
        for part in self._decimals.joined(ids):
            listed.update(previous)
            previous = part
        listed.update(previous[:-1])  # no space after the last
        for part in self._decoded.joined(ids):
            decoded.update(part)
        return len(ids), listed.hexdigest(), decoded.hexdigest()


class _Strings:
    """Byte strings by id, joined for whole arrays of ids."""

    STEP = 1 << 16  # ids joined at once, which bounds the index arrays for very long texts

    def __init__(self, strings: dict[int, bytes]):
        size = max(strings, default=-1) + 1
        ordered = [strings.get(i, b"") for i in range(size)]
        self._lengths = np.array([len(string) for string in ordered], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._flat = np.frombuffer(b"".join(ordered), np.uint8)

    def joined(self, ids: np.ndarray) -> Iterator[bytes]:
        for step in range(0, len(ids), self.STEP):
            part = ids[step : step + self.STEP]
            lengths = self._lengths[part]
            ends = np.cumsum(lengths)
            places = np.repeat(self._starts[part] - ends + lengths, lengths) + np.arange(ends[-1])
            yield self._flat[places].tobytes()


@lru_cache(maxsize=2)
def codec(path: str) -> ByteBpe:
    """One codec per Python worker and file."""
    return ByteBpe(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """``keys``, ``ids``, ``starts`` and ``ends`` (code points) per row.

    A null or empty text gives empty arrays; repeated rows give repeated rows;
    columns other than ``keys`` and the text are not read.
    """
    return per_text(
        docs,
        lambda: codec(path).encode_with_offsets,
        "ids array<int>, starts array<int>, ends array<int>",
        text,
        keys,
    )


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", keys: tuple = ("doc_id",)) -> DataFrame:
    """``keys`` and ``decoded`` (binary) of rows with ids; a null array decodes to nothing."""
    narrow = encoded.select(*keys, F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("_ids"))
    schema = StructType([narrow.schema[key] for key in keys] + [StructField("decoded", BinaryType())])

    def run(batches):
        decode = codec(path).decode
        for batch in batches:
            decoded = pa.array([decode(row) for row in batch.column("_ids").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(key) for key in keys), decoded], names=schema.names)

    return in_arrow(narrow, run, schema)


def digest_documents(docs: DataFrame, path: str, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """``n_tokens``, ``ids_sha256``, ``decoded_sha256``: ids are made and decoded again in one pass and not kept.

    A null text counts as empty: no ids, and the digests of nothing.
    """
    return per_text(
        docs, lambda: codec(path).digest, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", text, keys
    )
