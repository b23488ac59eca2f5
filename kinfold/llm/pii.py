"""Personal data: fixed rules, and a character BiLSTM with CRF that adds spans (operator 4)."""

from __future__ import annotations

import hashlib
import random
import re
from zlib import crc32
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kinfold.llm.batches import SLICE, in_arrow

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48  # every place near an anchor lies in two windows
SAMPLE = 1_000  # texts whose windows the tagger is trained on, and
PER_TEXT = 8  # windows of each of them, drawn by hash from all of its windows: the bounds of the training data
SURE = 0.5  # mean probability of a span's tags from which it is added

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind as listed, start, end


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest local part before it that begins after the last match, in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _low_parts(address: str) -> bool:
    return all(len(part := number.lstrip("0")) < 3 or len(part) == 3 and part <= "255" for number in address.split("."))


def base_spans(text: str) -> list[Span]:
    """Rule spans, leftmost without overlap per kind; a match that fails its check is dropped and not tried again."""
    found = [(0, *span) for span in _emails(text)] if "@" in text else []
    if _ANCHOR.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if _low_parts(m[0])]
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# Characters by shape: digits, lower and upper case are one symbol each, ASCII signs one each.
_SIGNS = " !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\n"
SYMBOLS = 5 + len(_SIGNS) + 1
_SYMBOL = {sign: 5 + place for place, sign in enumerate(_SIGNS)}
_ASCII = np.array(
    [
        _SYMBOL.get(chr(code), 1 if chr(code).isdigit() else 2 if chr(code).islower() else 3 if chr(code).isupper() else SYMBOLS - 1)
        for code in range(128)
    ]
)


def symbols(text: str) -> np.ndarray:
    """One symbol per code point, 0 after the end of a window; all letters beyond ASCII are one symbol."""
    codes = np.frombuffer(text.ljust(WINDOW, "\0")[:WINDOW].encode("utf-32-le", "surrogatepass"), "<u4")
    known = np.where(codes < 128, _ASCII[np.minimum(codes, 127)], 4)
    return np.where(np.arange(WINDOW) < len(text), known, 0)


TAGS = 1 + 2 * len(KINDS)  # outside; first and inner characters of each kind
_FORBIDDEN = -1e4
_RULES = np.zeros((TAGS, TAGS))
for _kind in range(len(KINDS)):
    _RULES[:, 2 + 2 * _kind] = _FORBIDDEN  # an inner character follows its own kind only
    _RULES[[1 + 2 * _kind, 2 + 2 * _kind], 2 + 2 * _kind] = 0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


class Tagger:
    """Embedding, one LSTM per direction, linear scores, CRF transitions."""

    def __init__(self, size: int = 10, hidden: int = 14, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.size, self.hidden = size, hidden
        small = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape)
        self.weights = {
            "embedding": rng.normal(0, 0.5, (SYMBOLS, size)),
            "cell": small(2, size + hidden, 4 * hidden),
            "bias": np.tile(np.repeat([0.0, 1.0, 0.0, 0.0], hidden), (2, 1)),
            "out": small(2 * hidden, TAGS),
            "shift": np.zeros(TAGS),
            "moves": np.zeros((TAGS, TAGS)),
        }

    def states(self, x: np.ndarray) -> tuple[np.ndarray, dict]:
        """Both directions' hidden states, in text order, and what the backward pass needs."""
        w, n = self.weights, self.hidden
        embedded = w["embedding"][x]
        both = np.stack([embedded, embedded[:, ::-1]])
        inputs = both @ w["cell"][:, None, : self.size] + w["bias"][:, None, None]
        rows, steps = x.shape
        h = c = np.zeros((2, rows, n))
        kept = {"both": both, "gates": [], "cells": [c], "hidden": [h]}
        for t in range(steps):
            z = inputs[:, :, t] + h @ w["cell"][:, self.size :]
            gates = _sigmoid(z[..., : 3 * n])
            new = np.tanh(z[..., 3 * n :])
            c = gates[..., n : 2 * n] * c + gates[..., :n] * new
            h = gates[..., 2 * n :] * np.tanh(c)
            kept["gates"].append((gates, new))
            kept["cells"].append(c)
            kept["hidden"].append(h)
        hidden = np.stack(kept["hidden"][1:], axis=2)
        return np.concatenate([hidden[0], hidden[1][:, ::-1]], axis=-1), kept

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.states(x)[0] @ self.weights["out"] + self.weights["shift"]

    def _moves(self) -> np.ndarray:
        return self.weights["moves"] + _RULES

    def _alphas_betas(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        moves = self._moves()
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0]
        for t in range(1, scores.shape[1]):
            alpha[:, t] = _logsum(alpha[:, t - 1, :, None] + moves, 1) + scores[:, t]
        for t in range(scores.shape[1] - 2, -1, -1):
            beta[:, t] = _logsum(moves + (scores[:, t + 1] + beta[:, t + 1])[:, None], 2)
        return alpha, beta, _logsum(alpha[:, -1], 1)

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        alpha, beta, total = self._alphas_betas(scores)
        return np.exp(alpha + beta - total[:, None, None])

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window."""
        moves = self._moves()
        rows, steps, _ = scores.shape
        best, back = scores[:, 0], np.zeros(scores.shape, np.int8)
        for t in range(1, steps):
            options = best[:, :, None] + moves
            back[:, t] = options.argmax(1)
            best = options.max(1) + scores[:, t]
        tags = np.empty((rows, steps), np.int64)
        tags[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(rows), t, tags[:, t]]
        return tags

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags and its gradients."""
        w, n, rows, steps = self.weights, self.hidden, *x.shape
        states, kept = self.states(x)
        scores = states @ w["out"] + w["shift"]
        alpha, beta, total = self._alphas_betas(scores)
        at = np.arange(rows)[:, None], np.arange(steps)[None]
        gold = scores[at[0], at[1], y].sum(1) + self._moves()[y[:, :-1], y[:, 1:]].sum(1)
        pull = np.exp(alpha + beta - total[:, None, None])
        pull[at[0], at[1], y] -= 1
        pairs = alpha[:, :-1, :, None] + self._moves() + (scores + beta)[:, 1:, None] - total[:, None, None, None]
        moves = np.exp(pairs).sum((0, 1))
        np.add.at(moves, (y[:, :-1], y[:, 1:]), -1)
        pull, moves = pull / rows, moves / rows
        flat = lambda a: a.reshape(-1, a.shape[-1])
        grads = {"out": flat(states).T @ flat(pull), "shift": pull.sum((0, 1)), "moves": moves}
        down = pull @ w["out"].T
        down = np.stack([down[..., :n], down[:, ::-1, n:]])
        cell, bias = np.zeros_like(w["cell"]), np.zeros_like(w["bias"])
        inputs = np.empty((2, rows, steps, self.size))
        dh = dc = np.zeros((2, rows, n))
        for t in range(steps - 1, -1, -1):
            gates, new = kept["gates"][t]
            i, f, o = gates[..., :n], gates[..., n : 2 * n], gates[..., 2 * n :]
            dh = dh + down[:, :, t]
            squashed = np.tanh(kept["cells"][t + 1])
            dc = dc + dh * o * (1 - squashed**2)
            dz = np.concatenate(
                [dc * new * i * (1 - i), dc * kept["cells"][t] * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - new**2)], axis=-1
            )
            joined = np.concatenate([kept["both"][:, :, t], kept["hidden"][t]], axis=-1)
            cell += joined.transpose(0, 2, 1) @ dz
            bias += dz.sum(1)
            before = dz @ w["cell"].transpose(0, 2, 1)
            inputs[:, :, t], dh, dc = before[..., : self.size], before[..., self.size :], dc * f
        grads |= {"cell": cell, "bias": bias, "embedding": np.zeros_like(w["embedding"])}
        np.add.at(grads["embedding"], x, inputs[0] + inputs[1][:, ::-1])
        return float((total - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 64, rate: float = 0.02, seed: int = 9) -> list[float]:
        """Adam over shuffled batches; returns the losses."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses = []
        for step in range(1, steps + 1):
            chosen = rng.choice(len(x), min(batch, len(x)), replace=False)
            loss, grads = self.gradients(x[chosen], y[chosen])
            losses.append(loss)
            now = rate * min(1, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g**2
                self.weights[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return losses


def window_starts(anchors: list[int]) -> list[int]:
    """Starts of the windows on the grid that hold an anchor or lie beside one that does."""
    cells = {place // STRIDE for place in anchors}
    return [cell * STRIDE for cell in sorted({cell + beside for cell in cells for beside in (-2, -1, 0, 1)}) if cell >= 0]


def tagged(start: int, spans: list[Span]) -> np.ndarray:
    """Tags of the window at ``start``."""
    tags = np.zeros(WINDOW, np.int64)
    for kind, first, last in spans:
        low, high = max(first - start, 0), min(last - start, WINDOW)
        if low < high:
            tags[low:high] = 2 + 2 * kind
            if first >= start:
                tags[low] = 1 + 2 * kind
    return tags


def _grouped(digits: str, sizes: list[int], mark: str) -> str:
    places = [sum(sizes[:n]) for n in range(len(sizes) + 1)]
    return mark.join(part for a, b in zip(places, [*places[1:], len(digits)]) if (part := digits[a:b]))


def varied(kind: int, rng: random.Random) -> str:
    """A made-up value of a kind in one of the forms in which it is written, most of which no rule matches."""
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    word = lambda letters, low, high: "".join(rng.choices(letters, k=rng.randint(low, high)))
    if kind == 0:
        letters = rng.choice(["abcdefghijklmnoprstuvw", "abcdefgäöüßéèñçø", "абвгдежик"])
        parts = [word(letters, 2, 14) for _ in range(rng.choice([1, 1, 2, 2, 3, 5]))]
        local = rng.choice([word("abcdefghijklmnop", 2, 9), f"{word('abcdefgh', 2, 7)}.{word('hijklmno', 2, 8)}", f"{word('abcdefgh', 2, 6)}{digits(2)}"])
        return f"{local}@{rng.choice('.-') .join(parts)}{rng.choice(['', '', '.com', '.org', '.de'])}"
    if kind == 1:
        return rng.choice(".-:,_").join(str(rng.randint(0, rng.choice([9, 255, 255]))) for _ in range(4))
    if kind == 2:
        number = digits(rng.choice([13, 14, 15, 15, 15, 18]) - 1)
        number += next(c for c in "0123456789" if luhn(number + c))
        return _grouped(number, [4, 4, 4, 4], rng.choice(["", " ", "-", ".", "/"]))
    country = rng.choice(["+", "00"]) + str(rng.randint(1, 99))
    return rng.choice(
        [
            f"{country} ({digits(3)}) {digits(3)}-{digits(4)}",
            f"({digits(3)}) {digits(3)}-{digits(4)}",
            f"{country} {digits(2)} {digits(3)} {digits(3)} {digits(2)}",
            _grouped(digits(10), [3, 3, 4], rng.choice("-. ")),
            f"0{digits(3)}{rng.choice(' /-')}{digits(6)}",
        ]
    )


def harmless(rng: random.Random) -> str:
    """Digits that are no personal data."""
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    return rng.choice(
        [
            f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
            f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}",
            f"{rng.randint(10, 23)}:{rng.randint(10, 59)}",
            f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}",
            f"{rng.randint(1, 999)},{digits(3)}.{digits(2)}",
            digits(rng.choice([1, 2, 3, 4, 5, 6, 9, 11, 16, 20])),
            f"#{digits(rng.randint(2, 8))}",
            f"{rng.randint(1, 400)}-{rng.randint(1, 400)}",
            f"@{rng.choice(['home', 'all', 'noon'])} {digits(2)}",
        ]
    )


def _doubtful(text: str, spans: list[Span]) -> list[Span]:
    """Places that look like a kind but failed its rule: no label, neither way, so no window with one is trained on."""
    found = [(1, *m.span()) for m in _IP.finditer(text)] + [(3, *m.span()) for m in _PHONE.finditer(text)]
    found += [(2, *m.span()) for m in _CARD.finditer(text) if 13 <= len(_digits(m[0])) <= 19]
    found += [(0, m.start(), m.end()) for m in re.finditer("@", text)]
    return [(kind, a, b) for kind, a, b in found if not any(k == kind and x <= a and b <= y for k, x, y in spans)]


def training_windows(text: str) -> list[tuple[str, list[int]]]:
    """Labelled windows of one text, at most ``PER_TEXT`` of its own, those with spans first, and variants of them.

    In a variant one span is written in another form of its kind, or a value of
    each kind (sometimes with other digits right after it) or a harmless number stands
    between two words, so that the tagger learns more than the rules
    find. Choices follow from a hash of the text.
    """
    rng = random.Random(crc32(text.encode("utf-8", "surrogatepass")))
    spans = base_spans(text)
    doubtful = _doubtful(text, spans)
    starts = window_starts([m.start() for m in _ANCHOR.finditer(text)])
    starts = [start for start in starts if not _overlaps(doubtful, start, start + WINDOW)]
    rng.shuffle(starts)
    starts.sort(key=lambda start: not _overlaps(spans, start, start + WINDOW))
    found = []

    def put(start: int, end: int, values: list[tuple[int, str]], before: str, after: str) -> None:
        """The window from ``start`` with ``values`` (kind or -1, text) in place of what ends at ``end``."""
        first = start + len(before)
        fresh, written = [], ""
        for kind, value in values:
            if kind >= 0:
                fresh.append((kind, first + len(written), first + len(written) + len(value)))
            written += value
        shift = first + len(written) - end
        fresh += [(kind, a + shift, b + shift) for kind, a, b in spans if a >= end]
        fresh += [(kind, a, b) for kind, a, b in spans if b <= first]
        whole = before + written + after
        if len(whole) >= 2 * len(before):  # the value itself lies in the window
            found.append((whole[:WINDOW], tagged(start, fresh).tolist()))

    for start in starts[:PER_TEXT]:
        window = text[start : start + WINDOW]
        found.append((window, tagged(start, spans).tolist()))
        for kind, a, b in spans:
            if start <= a and b <= start + WINDOW:
                put(start, b, [(kind, varied(kind, rng))], text[start:a], text[b : start + WINDOW])
    gaps = [m.start() for m in re.finditer(r" (?=\w)", text[: 50 * WINDOW]) if not _overlaps(spans, m.start(), m.start() + 1) and not _overlaps(doubtful, m.start() - WINDOW, m.start() + WINDOW)]
    for kind in (0, 0, 1, 2, 3, 3, -1, -1):
        if not gaps:
            break
        place = rng.choice(gaps) + 1
        start = max(place - rng.randint(0, WINDOW - 20), 0)
        values = [(kind, varied(kind, rng) if kind >= 0 else harmless(rng))]
        if kind in (1, 3) and rng.random() < 0.4:
            values += [(-1, " "), (1, ".".join(str(rng.randint(0, 255)) for _ in range(4)))]
        values.append((-1, rng.choice([" ", ", ", ". ", " "])))
        put(start, place, values, text[start:place], text[place : place + WINDOW])
    return found


def train(docs: DataFrame, text: str = "text") -> Tagger | None:
    """A tagger fitted on windows of at most ``SAMPLE`` different texts with digits or ``@``, those of smallest hash.

    Labels are the rule spans. Without any window there is no tagger. The sample is
    settled on hashes alone, so texts outside it are never moved, and copies of
    one text meet in a partial aggregate.
    """
    texts = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]")).withColumn("hash", F.xxhash64("text"))
    last = texts.select("hash").distinct().orderBy("hash").limit(SAMPLE).agg(F.max("hash")).first()[0]
    if last is None:
        return None
    sample = texts.filter(F.col("hash") <= last).groupBy("hash").agg(F.min("text").alias("text")).select("text")

    def run(batches):
        for batch in batches:
            rows = [window for value in batch.column(0).to_pylist() for window in training_windows(value)]
            arrays = [pa.array([row[0] for row in rows], pa.string()), pa.array([row[1] for row in rows], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["window", "tags"])

    rows = in_arrow(sample, run, "window string, tags array<bigint>").collect()
    if not rows:
        return None
    rows.sort(key=lambda row: (row.window, row.tags))
    tagger = Tagger()
    tagger.fit(np.stack([symbols(row.window) for row in rows]), np.array([row.tags for row in rows]))
    return tagger


_EDGE = frozenset(" \t\n\r\x0b\x0c\"'<>()[]{},;|")
_NUMBER = {1: re.compile(r"[0-9]+(?:[^0-9A-Za-z\s][0-9]+){3}"), 2: re.compile(r"[0-9 ./-]+"), 3: re.compile(r"[(+0-9][0-9 ()./-]*[0-9]")}


def snapped(text: str, kind: int, start: int, end: int, covered: np.ndarray) -> tuple[int, int]:
    """The span with its edges on those of the word or number that it touches, never over a rule span."""
    if kind == 0:
        start = end = max(text.find("@", start, end), start)  # an address has no blanks: it is the word around its sign
        while start > 0 and text[start - 1] not in _EDGE and not covered[start - 1]:
            start -= 1
        while end < len(text) and text[end] not in _EDGE and not covered[end]:
            end += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        while start < end and not text[start].isalnum():
            start += 1
        return start, end
    digit = lambda place: "0" <= text[place] <= "9" and not covered[place]
    while start > 0 and digit(start - 1):
        start -= 1
    while end < len(text) and digit(end):
        end += 1
    if kind == 3 and start > 0 and text[start - 1] in "+(" and not covered[start - 1]:
        start -= 1
    while end > start and not digit(end - 1):
        end -= 1
    while start < end and not (digit(start) or kind == 3 and text[start] in "+("):
        start += 1
    return start, end


def plausible(kind: int, value: str) -> bool:
    """Length and characters of a kind; a card's check sum too, since any number of its length would do otherwise."""
    if kind == 0:
        local, _, domain = value.partition("@")
        return bool(local) and len(domain) > 3 and "@" not in domain and ":" not in value and "/" not in value
    digits = _digits(value)
    if not _NUMBER[kind].fullmatch(value):
        return False
    if kind == 1:
        return _low_parts(re.sub("[^0-9]", ".", value))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and len(value) - len(digits) >= (1 if value[0] in "+(0" else 2)


def _overlaps(spans: list[Span], start: int, end: int) -> bool:
    return any(first < end and start < last for _, first, last in spans)


def added_spans(tagger: Tagger, texts: list[str], bases: list[list[Span]]) -> list[list[Span]]:
    """Spans that the tagger finds beside the base spans, per text.

    Windows lie around digits and ``@`` that no base span covers, since each
    span added has one of those. Overlapping windows are put together before spans are
    read off: every character takes its tag from the window in whose middle it
    lies, so a span may run over any number of windows. Its edges are those of
    the word or number, and it never overlaps a base span. Over the whole text the surest span
    wins, then the first.
    """
    places: list[tuple[int, int]] = []
    covers: list[np.ndarray] = []
    for row, (text, spans) in enumerate(zip(texts, bases)):
        covered = np.zeros(len(text) + WINDOW, bool)
        for _, start, end in spans:
            covered[start:end] = True
        covers.append(covered)
        places += [(row, start) for start in window_starts([m.start() for m in _ANCHOR.finditer(text) if not covered[m.start()]]) if start < len(text)]
    joined: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # tags and their probabilities, for texts with any tag
    known = set(places)
    margin = (WINDOW - STRIDE) // 2
    for at in range(0, len(places), 1024):
        part = places[at : at + 1024]
        scores = tagger.scores(np.stack([symbols(texts[row][start : start + WINDOW]) for row, start in part]))
        tags = tagger.decode(scores)
        hits = np.flatnonzero(tags.any(axis=1))
        if not len(hits):
            continue
        sure = np.take_along_axis(tagger.probabilities(scores[hits]), tags[hits][:, :, None], 2)[:, :, 0]
        for hit, probabilities in zip(hits, sure):
            row, start = part[hit]
            if row not in joined:
                joined[row] = np.zeros(len(covers[row]), np.int64), np.zeros(len(covers[row]))
            low = margin if (row, start - STRIDE) in known else 0
            high = WINDOW - margin if (row, start + STRIDE) in known else WINDOW
            for whole, own in zip(joined[row], (tags[hit], probabilities)):
                whole[start + low : start + high] = own[low:high]
    found: list[list[Span]] = [[] for _ in texts]
    for row, (tags, probabilities) in joined.items():
        text, covered, options = texts[row], covers[row], {}
        tags[covered] = 0
        for kind, first, last in runs(tags[: len(text)]):
            score = float(probabilities[first:last].mean())
            span = (kind, *snapped(text, kind, first, last, covered))
            if score >= SURE and plausible(kind, text[span[1] : span[2]]):
                options[span] = max(score, options.get(span, 0))
        for span in sorted(options, key=lambda span: (-options[span], span[1], span[0])):
            if not _overlaps(bases[row], span[1], span[2]) and not _overlaps(found[row], span[1], span[2]):
                found[row].append(span)
    return found


def runs(tags: np.ndarray) -> Iterator[Span]:
    """Kind, start and end of each tagged stretch."""
    start = kind = -1
    for place, tag in enumerate([*tags.tolist(), 0]):
        own = (tag - 1) // 2 if tag else -1
        if start >= 0 and (own != kind or tag % 2):
            yield kind, start, place
            start = -1
        if tag and start < 0:
            start, kind = place, own


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans))


def find(docs: DataFrame, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """``keys``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans`` and ``n_added`` per row.

    Counts and hash are of the rule spans; ``spans`` lists those and the tagger's.
    A null text counts as empty; repeated rows give repeated rows. Training reads a
    bounded sample, the search reads every text whole.
    """
    tagger = train(docs, text)
    narrow = docs.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    fields = ", ".join(f"n_{kind} bigint" for kind in KINDS) + ", base_sha256 string, spans string, n_added bigint"
    schema = StructType([narrow.schema[key] for key in keys] + StructType.fromDDL(fields).fields)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column("_text").to_pylist()
                bases = [base_spans(value) for value in texts]
                added = added_spans(tagger, texts, bases) if tagger else [[] for _ in texts]
                counts = [pa.array([sum(span[0] == kind for span in spans) for spans in bases], pa.int64()) for kind in range(len(KINDS))]
                digests = pa.array([hashlib.sha256(_listed(spans).encode()).hexdigest() for spans in bases])
                every = pa.array([_listed(base + more) for base, more in zip(bases, added)])
                columns = [part.column(key) for key in keys]
                more = pa.array([len(spans) for spans in added], pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, *counts, digests, every, more], names=schema.names)

    return in_arrow(narrow, run, schema)
