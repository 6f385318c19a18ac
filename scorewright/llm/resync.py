"""Token ids of very long texts from overlapping chunks that are spliced where both agree.

A chunk that begins anywhere may be cut wrongly at first, but the splitting pattern is memoryless: what
follows a place where a match begins depends on nothing before it. So a place where a piece begins both in
a chunk known to be right up to there and in the next chunk is a boundary of the whole text too, and from
it on the next chunk is right as well. Places within ``guard`` of a chunk's end are not trusted, as the
pattern looks ahead there and a special string may be cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from scorewright.llm.pieces import ByteTokenizer

#: Characters of a chunk, of the first overlap, and chunks encoded at once.
CHUNK, OVERLAP, TOGETHER = 1 << 16, 1 << 9, 16


def spliced_ids(tokenizer: ByteTokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[np.ndarray]:
    """The ids of ``text`` in order, a chunk at a time."""
    n = len(text)
    guard = max([0, *map(len, tokenizer.specials)]) + 8
    bases = list(range(0, max(n, 1), chunk))
    ahead: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def marks(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if k not in ahead:
            own = range(k, min(k + TOGETHER, len(bases)))
            encoded = tokenizer.marks([text[bases[i] : bases[i] + chunk + overlap] for i in own])
            ahead.update({i: (s + bases[i], c, ids) for i, (s, c, ids) in zip(own, encoded, strict=True)})
        return ahead[k]

    k, sure = 0, 0
    end = min(n, chunk + overlap)
    starts, counts, ids = marks(0)
    while end < n:
        found = None
        for j in range(k + 1, len(bases)):
            if bases[j] + guard > end:
                break
            common = np.intersect1d(starts, marks(j)[0], assume_unique=True)
            common = common[(common > sure) & (common + guard <= end)]
            if len(common):
                found = j, int(common[0])
                break
        if found is None:  # no agreement: widen this chunk's overlap
            end = min(n, end + max(overlap, end - bases[k]))
            begin = sure
            (starts, counts, ids), = tokenizer.marks([text[begin:end]])
            starts = starts + begin
            continue
        j, cut = found
        yield _between(starts, counts, ids, sure, cut)
        for i in [i for i in ahead if i < j]:
            del ahead[i]
        k, sure = j, cut
        end = min(n, bases[k] + chunk + overlap)
        starts, counts, ids = marks(k)
    yield _between(starts, counts, ids, sure, n)


def _between(starts: np.ndarray, counts: np.ndarray, ids: np.ndarray, low: int, high: int) -> np.ndarray:
    at = np.concatenate([[0], np.cumsum(counts)])
    a, b = np.searchsorted(starts, [low, high])
    return ids[at[a] : at[b]]
