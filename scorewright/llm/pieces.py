"""Vectorised splitting of texts into the pieces that byte-level BPE vocabularies merge.

Texts of a slice are laid out as one array of code points. Character classes come from the tokenizer
library itself, asked once per distinct character, so the split follows its Unicode tables. Pieces are
then told apart by a 64-bit polynomial fingerprint, and the merge work is done once per distinct piece.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one thread

UNKNOWN, LETTER, NUMBER, SPACE, OTHER = range(5)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n, grown on demand."""
    name, base = ("inverse", _BASE_INVERSE) if inverse else ("base", _BASE)
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 << 20:
            _powers[name] = have
    return have[:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the spans ``[start, end)`` of an integer array."""
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(len(codes)), out=total[1:])
    h = (total[ends] - total[starts]) * powers(len(codes) + 1, inverse=True)[starts]
    h ^= (ends - starts).astype(np.uint64) * _LENGTH
    h ^= h >> np.uint64(29)
    return h


class Classes:
    """Classes of code points, as a splitting function of the library tells them."""

    def __init__(self, split: Callable[[str], list]):
        self.table = np.zeros(0x110000, np.uint8)
        self.split = split

    def _ask(self, c: str) -> int:
        for before, kind in (("x", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(self.split(before + c)) == 1:
                return kind
        return SPACE

    def of(self, codes: np.ndarray) -> np.ndarray:
        found = self.table[codes]
        if not found.all():
            for x in np.unique(codes[found == UNKNOWN]):
                self.table[x] = self._ask(chr(x))
            found = self.table[codes]
        return found


@dataclass
class Layout:
    """Texts of a slice as one array of code points; ``first`` marks the first one of each text."""

    joined: str
    codes: np.ndarray
    bounds: np.ndarray
    first: np.ndarray


def lay_out(texts: list[str]) -> Layout:
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    first = np.zeros(len(codes) + 1, bool)
    first[bounds] = True
    return Layout(joined, codes, bounds, first[:-1])


def _run_starts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    runs = first.copy()
    runs[1:] |= classes[1:] != classes[:-1]
    return runs


def _contractions(codes: np.ndarray, classes: np.ndarray, first: np.ndarray, runs: np.ndarray, starts: np.ndarray, joins_space: bool) -> None:
    """Split off 's 't 're 've 'm 'll 'd where a match can begin at the quote."""
    n = len(codes)
    quotes = np.flatnonzero((codes == 0x27) & runs)
    for i in quotes[quotes + 1 < n].tolist():
        if first[i + 1] or classes[i + 1] != LETTER or joins_space and i and not first[i] and codes[i - 1] == 0x20:
            continue
        one = chr(codes[i + 1])
        two = one + chr(codes[i + 2]) if i + 2 < n and not first[i + 2] else ""
        k = 1 if one in "stmd" else 2 if two in ("re", "ve", "ll") else 0
        if k:
            starts[i + 1] = False
            if i + 1 + k < n and not runs[i + 1 + k]:
                starts[i + 1 + k] = True


def byte_level_starts(layout: Layout, classes: np.ndarray) -> np.ndarray:
    """Marks the first character of each piece: runs of one class with the blank before them."""
    codes, first = layout.codes, layout.first
    runs = _run_starts(classes, first)
    starts = runs.copy()
    last = np.flatnonzero((classes[:-1] == SPACE) & (classes[1:] != SPACE) & ~first[1:])
    starts[last] = True
    starts[last[codes[last] == 0x20] + 1] = False
    _contractions(codes, classes, first, runs, starts, joins_space=True)
    return starts


def word_starts(layout: Layout, classes: np.ndarray) -> np.ndarray:
    """As above, but digits stand alone and white space belongs to no piece (its runs are marked too)."""
    codes, first = layout.codes, layout.first
    runs = _run_starts(classes, first)
    starts = runs | (classes == NUMBER)
    _contractions(codes, classes, first, runs, starts, joins_space=False)
    return starts


@dataclass
class Pieces:
    """Pieces of a slice: where each begins, its text's row, and the index of its distinct form."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    forms: np.ndarray
    words: list[str]
    hashes: np.ndarray


def distinct_pieces(layout: Layout, starts: np.ndarray, keep: np.ndarray | None = None) -> Pieces:
    begin = np.flatnonzero(starts)
    end = np.append(begin[1:], len(layout.codes))
    if keep is not None:
        chosen = keep[begin]
        begin, end = begin[chosen], end[chosen]
    hashes = span_hashes(layout.codes, begin, end)
    forms, uniques = pd.factorize(hashes)
    at = np.empty(len(uniques), np.int64)
    at[forms[::-1]] = np.arange(len(forms) - 1, -1, -1)
    joined = layout.joined
    words = [joined[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
    rows = np.searchsorted(layout.bounds, begin, side="right") - 1
    return Pieces(begin, end, rows, forms, words, np.asarray(uniques, np.uint64))


@dataclass
class Ids:
    """Token ids of the forms of a slice: form f has ``sizes[f]`` ids at ``offsets[f]`` of ``flat``."""

    flat: np.ndarray
    offsets: np.ndarray
    sizes: np.ndarray

    def of(self, forms: np.ndarray) -> np.ndarray:
        """The ids of pieces one after another."""
        counts = self.sizes[forms]
        total = int(counts.sum())
        shift = np.repeat(self.offsets[forms] - (np.cumsum(counts) - counts), counts)
        return self.flat[shift + np.arange(total)]


class Merger:
    """Token ids of distinct pieces, kept between slices up to ``bound`` pieces."""

    def __init__(self, merge: Callable[[list[str]], list[list[int]]], bound: int = 200_000):
        self.merge, self.bound = merge, bound
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.sizes = np.zeros(1 << 14, np.int64)
        self.offsets = np.zeros(1 << 14, np.int64)
        self.used = 0

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        if n <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)])

    def table(self, pieces: Pieces) -> Ids:
        keys = pieces.hashes.tolist()
        slots = np.array([self.slots.get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(self.slots) + len(new) > self.bound and self.slots:
            self._clear()
            slots[:], new = -1, np.arange(len(keys))
        if len(new):
            lists = self.merge([pieces.words[i] for i in new.tolist()])
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            low, n, total = len(self.slots), len(new), int(sizes.sum())
            self.ids = self._room(self.ids, self.used + total)
            self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(lists), np.uint32, total)
            self.sizes, self.offsets = self._room(self.sizes, low + n), self._room(self.offsets, low + n)
            self.sizes[low : low + n] = sizes
            self.offsets[low : low + n] = self.used + np.cumsum(sizes) - sizes
            self.used += total
            slots[new] = np.arange(low, low + n)
            self.slots.update(zip([keys[i] for i in new.tolist()], range(low, low + n), strict=True))
        return Ids(self.ids, self.offsets[slots], self.sizes[slots])


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: printable Latin-1 bytes
    stand for themselves, the others for characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    for b in range(256):
        if b not in table:
            table[b] = chr(0x100 + len(table) - len(own))
    return table


class ByteTokenizer:
    """Ids of whole texts as ``Tokenizer.from_file(path)`` gives them, without added tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.specials = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        split = library.pre_tokenizer
        self.classes = Classes(split.pre_tokenize_str)
        alphabet = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        tokenize = library.model.tokenize

        def merge(words: list[str]) -> list[list[int]]:
            shown = (w.replace(" ", "\u0120") if w.isascii() and w.strip(" ").isalnum() else w.encode().decode("latin-1").translate(alphabet) for w in words)
            return [[t.id for t in tokenize(w)] for w in shown]

        self.merger = Merger(merge)

    def _parts(self, texts: list[str]) -> tuple[list[str], list[tuple[int, int]]]:
        """Texts cut around special strings: parts, and (row, id or -1) of each."""
        parts, of = [], []
        for row, text in enumerate(texts):
            found = [s for s in self.specials if s in text]
            if not found:
                parts.append(text)
                of.append((row, -1))
                continue
            at = 0
            while True:
                nexts = [(i, -len(s), s) for s in found if (i := text.find(s, at)) >= 0]
                if not nexts:
                    break
                i, _, s = min(nexts)
                parts += [text[at:i], ""]
                of += [(row, -1), (row, self.specials[s])]
                at = i + len(s)
            parts.append(text[at:])
            of.append((row, -1))
        return parts, of

    def pieces(self, texts: list[str]) -> tuple[Layout, Pieces, Ids]:
        layout = lay_out(texts)
        if not len(layout.codes):
            none = np.zeros(0, np.int64)
            return layout, Pieces(none, none, none, none, [], np.zeros(0, np.uint64)), Ids(np.zeros(0, np.uint32), none, none)
        pieces = distinct_pieces(layout, byte_level_starts(layout, self.classes.of(layout.codes)))
        return layout, pieces, self.merger.table(pieces)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        parts, of = self._parts(texts)
        _, pieces, table = self.pieces(parts)
        ids = table.of(pieces.forms)
        counts = np.bincount(pieces.rows, weights=table.sizes[pieces.forms], minlength=len(parts)).astype(np.int64)
        cut = np.split(ids, np.cumsum(counts)[:-1]) if parts else []
        if len(parts) == len(texts):
            return cut
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for part, (row, special) in zip(cut, of, strict=True):
            out[row].append(part if special < 0 else np.array([special], np.uint32))
        return [np.concatenate(x) for x in out]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        parts, of = self._parts(texts)
        _, pieces, table = self.pieces(parts)
        per_part = np.bincount(pieces.rows, weights=table.sizes[pieces.forms], minlength=len(parts))
        rows, special = (np.array(x, np.int64) for x in zip(*of, strict=True)) if of else (np.zeros(0, np.int64),) * 2
        return np.bincount(rows, weights=per_part + (special >= 0), minlength=len(texts)).astype(np.int64)

    def marks(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text the starts of its pieces and special strings, their numbers of ids, and the ids."""
        parts, of = self._parts(texts)
        layout, pieces, table = self.pieces(parts)
        counts = table.sizes[pieces.forms]
        cut = np.searchsorted(pieces.rows, np.arange(len(parts) + 1))
        out: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in texts]
        at = [0] * len(texts)
        names = {i: s for s, i in self.specials.items()}
        for k, (row, special) in enumerate(of):
            if special >= 0:
                out[row].append((np.array([at[row]]), np.array([1]), np.array([special], np.uint32)))
                at[row] += len(names[special])
            else:
                own = slice(cut[k], cut[k + 1])
                out[row].append((pieces.starts[own] - layout.bounds[k] + at[row], counts[own], table.of(pieces.forms[own])))
                at[row] += int(layout.bounds[k + 1] - layout.bounds[k])
        return [tuple(np.concatenate(x) for x in zip(*own, strict=True)) for own in out]


@lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)
