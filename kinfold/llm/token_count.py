"""Token counts by heap and linked list, without ids (operator 3)."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.batches import per_text
from kinfold.llm.byte_bpe import show_bytes
from kinfold.llm.words import Memory, latin_pieces, spaced_words


PLACE = 32  # bits of a heap entry that hold the place


class Merges:
    """Merge ranks over numbered symbols."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.numbers: dict[str, int] = {}
        number = lambda symbol: self.numbers.setdefault(symbol, len(self.numbers))
        self.parts = [(number(first), number(second), number(first + second)) for first, second in pairs]
        self.rank = {first << PLACE | second: rank for rank, (first, second, _) in enumerate(self.parts)}

    def symbols_left(self, piece: str) -> int:
        """Initial symbols minus merges, where the adjacent pair of lowest rank (then the leftmost) merges first.

        The symbols form a doubly linked list; a heap holds the pairs that can
        merge. An entry whose symbols have changed since is passed over.
        """
        left_over = end = len(piece)
        number, rank_of, parts = self.numbers.get, self.rank.get, self.parts
        symbols = [number(symbol, -1) for symbol in piece]
        heap = [
            rank << PLACE | at
            for at, (first, second) in enumerate(zip(symbols, symbols[1:]))
            if first >= 0 and second >= 0 and (rank := rank_of(first << PLACE | second)) is not None
        ]
        if not heap:
            return left_over
        heapify(heap)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        while heap:
            entry = heappop(heap)
            at = entry & 0xFFFFFFFF
            first, second, joined = parts[entry >> PLACE]
            other = after[at]
            if symbols[at] != first or other == end or symbols[other] != second:
                continue
            symbols[at], symbols[other] = joined, -1
            left_over -= 1
            following = after[at] = after[other]
            if following < end:
                before[following] = at
                if (beyond := symbols[following]) >= 0 and (rank := rank_of(joined << PLACE | beyond)) is not None:
                    heappush(heap, rank << PLACE | at)
            if (previous := before[at]) >= 0:
                if (symbol := symbols[previous]) >= 0 and (rank := rank_of(symbol << PLACE | joined)) is not None:
                    heappush(heap, rank << PLACE | previous)
        return left_over


class TokenCounter:
    """Counts for one byte-level BPE file in the ``tokenizers`` format."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        kind = (parts["pre_tokenizer"] or {}).get("type")
        plain = not any(model.get(key) for key in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if parts["normalizer"] or kind != "ByteLevel" or model["type"] != "BPE" or not plain:
            raise ValueError(f"{path}: only plain byte-level BPE can be counted")
        pairs = [tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in model["merges"]]
        self._merges = Merges(pairs)
        self._pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = sorted((token["content"] for token in parts["added_tokens"]), key=len, reverse=True)
        self._special = special
        self._special_pattern = re.compile("|".join(map(re.escape, special))) if special else None
        self._counts = Memory(self._count_word)
        self._piece_counts = Memory(self._count_piece)

    def _count_word(self, word: str) -> int:
        pieces = latin_pieces(word)
        if pieces is None:
            return sum(self._merges.symbols_left(piece) for piece, _ in self._pieces(word))
        return sum(map(self._piece_counts.__getitem__, pieces))

    def _count_piece(self, piece: str) -> int:
        return self._merges.symbols_left(show_bytes(piece.encode()))

    def _count_plain(self, text: str) -> int:
        return sum(map(self._counts.__getitem__, spaced_words(text))) if text else 0

    def count(self, text: str) -> int:
        """Tokens of a text; a special token's string inside it is one token, as the library has it by default."""
        if any(special in text for special in self._special):
            parts = self._special_pattern.split(text)
            return len(parts) - 1 + sum(map(self._count_plain, parts))
        return self._count_plain(text)


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter per Python worker and file."""
    return TokenCounter(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text", keys: tuple = ("doc_id",), limit: int = 1024) -> DataFrame:
    """``keys``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row.

    A null text counts as empty: no bytes, no tokens, not over the limit.
    """
    counted = per_text(
        docs, lambda: lambda value: (len(value.encode()), counter(path).count(value)), "n_bytes bigint, n_tokens bigint", text, keys
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
