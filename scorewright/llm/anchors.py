"""Content-chosen places of byte texts, and fingerprints of the bytes around them.

Of all heads (runs of ``HEAD`` bytes) inside a string of ``LENGTH`` bytes, the one with the least fingerprint
is the string's anchor, the leftmost of equal ones. Equal strings have their anchor at the same place, so all
strings that are equal anywhere meet at anchors with the same head. Strings that start next to each other
mostly share their anchor: a run of starts ``[anchor - back, anchor + ahead]`` is one entry.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from scorewright.llm.pieces import powers
from scorewright.llm.shingles import mixed

#: Bytes of a repeated string and of a head.
LENGTH, HEAD = 200, 64


@dataclass
class Rolling:
    """Fingerprints of any spans of the bytes of several texts laid end to end."""

    data: np.ndarray
    totals: np.ndarray
    bounds: np.ndarray

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.totals[ends] - self.totals[starts]) * powers(len(self.totals), inverse=True)[starts]
        return mixed(h)


def roll(raw: list[bytes]) -> Rolling:
    data = np.frombuffer(b"".join(raw), np.uint8)
    totals = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=totals[1:])
    bounds = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=bounds[1:])
    return Rolling(data, totals, bounds)


@dataclass
class Runs:
    """Entries of a slice: text, anchor (byte in its text), starts before and after it, head, and whole run."""

    row: np.ndarray
    anchor: np.ndarray
    back: np.ndarray
    ahead: np.ndarray
    head: np.ndarray
    whole: np.ndarray


def runs(rolling: Rolling, length: int = LENGTH, head: int = HEAD) -> Runs:
    n, width = len(rolling.data), length - head + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return Runs(none, none, none, none, none.view(np.uint64), none.view(np.uint64))
    count = n - head + 1
    at = np.arange(count)
    heads = mixed((rolling.totals[head:] - rolling.totals[:count]) * powers(count, inverse=True))
    # Minima of all windows from minima towards both ends of blocks; the low byte holds the place in the block.
    blocks = -(-count // width)
    keyed = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    keyed[:count] = heads & np.uint64(0xFFFFFFFFFFFFFF00) | (at % width).astype(np.uint64)
    keyed = keyed.reshape(blocks, width)
    after = np.minimum.accumulate(keyed[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(keyed, axis=1).ravel()
    starts = np.arange(n - length + 1)
    row = np.searchsorted(rolling.bounds, starts, side="right") - 1
    starts = starts[starts + length <= rolling.bounds[row + 1]]
    left, right = after[starts], before[starts + width - 1]
    low = np.uint64(255)
    place_left = starts // width * width + (left & low).astype(np.int64)
    place_right = (starts + width - 1) // width * width + (right & low).astype(np.int64)
    anchor = np.where(left & ~low <= right & ~low, place_left, place_right)
    row = np.searchsorted(rolling.bounds, starts, side="right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    a, s, e = anchor[first], starts[first], starts[last]
    return Runs(row[first], a - rolling.bounds[row[first]], a - s, e - a, heads[a], rolling.spans(s, e + length))
