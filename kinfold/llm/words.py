"""Texts cut into words whose tokens do not depend on their neighbours, and a bounded memory of results per word."""

from __future__ import annotations

import re
from collections.abc import Callable

LONGEST_KEPT = 64  # longer words hardly ever come back
MOST_KEPT = 1_000_000  # words remembered per Python worker, about 200 MB

_OTHER_SPACE = re.compile(r"[^\S \n]")
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)")
# A line end, a space with Latin letters, ASCII signs other than the apostrophe: the usual pattern cuts just there.
_LATIN = re.compile(r"(\n?)( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)")


class Memory(dict):
    """Results of ``work`` by word. A full memory is emptied, which bounds it whatever the vocabulary."""

    def __init__(self, work: Callable[[str], object], most: int = MOST_KEPT):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, word: str):
        found = self.work(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.clear()
            self[word] = found
        return found


def spaced_words(text: str) -> list[str]:
    """Words with the one space or line end before them; joined they are the text again.

    The usual byte-level pattern never matches across a single space or line end
    between two characters that are not white space, so these words can be
    tokenized one by one. Longer runs of white space stay inside a word.
    """
    plain = not (
        "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\0" in text
        or text.endswith((" ", "\n")) or _OTHER_SPACE.search(text)
    )
    if plain:
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return _BOUNDARY.split(text)


def latin_pieces(word: str) -> list[str] | None:
    """The pieces of a plain Latin word, without the cost of the full pattern; None for any other word."""
    match = _LATIN.fullmatch(word)
    return [piece for piece in match.groups() if piece] if match else None
