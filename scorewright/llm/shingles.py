"""Word shingles of whole texts as sorted 64-bit fingerprints."""

from __future__ import annotations

import numpy as np

from scorewright.llm.pieces import span_hashes

#: Words of a shingle.
WORDS = 5
_STEP = np.uint64(0xD6E8FEB86659FD93)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_blank = np.zeros(256, bool)
_blank[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose results look random."""
    h = h.copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The set of each text, ascending: its distinct runs of ``words`` words, or of all its words if fewer.

    Words are what blanks (U+0020, U+0009 to U+000D) separate, with A to Z in lower case.
    """
    raw = [t.encode() for t in texts]
    joined = np.frombuffer(b" ".join(raw), np.uint8)
    sizes = np.array([len(r) for r in raw], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    inside = ~_blank[joined]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = mixed(span_hashes(_lower[joined], starts, ends)) if len(starts) else np.zeros(0, np.uint64)
    counts = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    runs = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        runs = runs * _STEP + h[k : len(h) - words + 1 + k]
    runs = mixed(runs)
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(runs[at : at + n - words + 1]))
        elif n:
            few = np.uint64(n)
            for x in h[at : at + n]:
                few = np.uint64((int(few) * int(_STEP) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mixed(np.array([few], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def set_id(shingles: np.ndarray) -> int:
    """One number for a set, the same for equal sets (signed, as a long)."""
    both = int(mixed(shingles + np.uint64(len(shingles))).sum(dtype=np.uint64)) if len(shingles) else 0
    return both - (1 << 64) if both >= 1 << 63 else both
