"""Order-preserving packing of token streams into windows, by dynamic programming.

The ids of a partition's documents form one stream in the order of the rows. Windows are cut at ends of
documents, ends of sentences, or else at places of a fixed grid; the cheapest cuts minimise padding plus a
penalty for each cut that is not the end of a document. As a window of length w costs ``window - w``, the
best predecessor of a place is the minimum of ``cost + place`` over the last ``window`` tokens, which a
monotone queue keeps. The stream is solved in segments of bounded length; the last window of a segment is
carried into the next one.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.pieces import ByteTokenizer, byte_tokenizer
from scorewright.llm.resync import CHUNK, spliced_ids

#: Tokens of a window and of a segment, and the id that ends a document.
WINDOW, SEGMENT, END = 2048, 1 << 20, 1
#: What a cut costs in tokens of padding, at the end of a sentence and elsewhere; distance of the other places.
SENTENCE_COST, OTHER_COST, GRID = 8, 48, 32


def best_cuts(places: np.ndarray, costs: np.ndarray, window: int, whole: bool) -> list[int]:
    """Indices into ``places`` of the cheapest chain of windows from ``places[0]``.

    The chain ends at the last place if ``whole``, otherwise at the cheapest place within a window of it.
    """
    at, extra = places.tolist(), costs.tolist()
    n = len(at)
    reach = [0] * n  # cost of the best chain to a place, plus the place
    before = [0] * n
    reach[0] = at[0]
    queue = deque([0])
    for j in range(1, n):
        low = at[j] - window
        while at[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        before[j] = i
        cost = reach[j] = reach[i] + window + extra[j]
        while queue and reach[queue[-1]] >= cost:
            queue.pop()
        queue.append(j)
    last = n - 1
    if not whole:
        last = min(queue, key=lambda j: reach[j] - at[j])
    chain = [last]
    while chain[-1]:
        chain.append(before[chain[-1]])
    return chain[::-1]


class Stream:
    """Documents of a partition that are not yet packed, and the pieces of finished windows."""

    def __init__(self, sentence_end: np.ndarray, first_sequence: int, window: int = WINDOW):
        self.sentence_end, self.sequence, self.window = sentence_end, first_sequence, window
        self.held: list[tuple[object, int, int, np.ndarray]] = []  # key, start, tokens of the document, ids
        self.size = 0

    def add(self, key: object, ids: np.ndarray) -> None:
        self.held.append((key, 0, len(ids), ids))
        self.size += len(ids)

    def cut(self, whole: bool) -> list[tuple]:
        """Pack what is held: all of it, or all but the last window."""
        if not self.size:
            return []
        ids = np.concatenate([x[3] for x in self.held])
        lengths = np.array([len(x[3]) for x in self.held])
        begins = np.cumsum(lengths) - lengths
        ends = begins + lengths
        cost = np.full(len(ids) + 1, -1, np.int64)
        cost[::GRID] = OTHER_COST
        cost[1:][self.sentence_end[ids]] = SENTENCE_COST
        cost[ends] = 0
        cost[0] = 0
        if self.held[-1][1] + lengths[-1] < self.held[-1][2]:
            cost[-1] = OTHER_COST  # the last document goes on
        places = np.flatnonzero(cost >= 0)
        cuts = places[best_cuts(places, cost[places], self.window, whole)]
        done = int(cuts[-1])
        bounds = np.unique(np.concatenate([cuts, begins[begins < done]]))
        docs = np.searchsorted(begins, bounds[:-1], side="right") - 1
        windows = np.searchsorted(cuts, bounds[:-1], side="right") - 1
        raw = ids.astype("<u4").tobytes()
        out = []
        for a, b, d, w in zip(bounds[:-1].tolist(), bounds[1:].tolist(), docs.tolist(), windows.tolist(), strict=True):
            key, start, total, _ = self.held[d]
            out.append((key, start + a - int(begins[d]), b - a, zlib.crc32(raw[4 * a : 4 * b]), total, self.sequence + w, a - int(cuts[w])))
        self.sequence += len(cuts) - 1
        rest = [(key, start + max(0, done - int(b)), total, part[max(0, done - int(b)) :]) for (key, start, total, part), b in zip(self.held, begins, strict=True) if b + len(part) > done]
        self.held, self.size = rest, len(ids) - done
        return out


def sentence_ends(vocabulary: str) -> np.ndarray:
    """Marks the ids whose token ends a sentence or holds a line break."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    marks = np.zeros(library.get_vocab_size(), bool)
    for token, i in library.get_vocab().items():
        marks[i] = token[-1] in ".!?" or "Ċ" in token  # U+010A stands for the line feed
    return marks


def _ids(tokenizer: ByteTokenizer, texts: list[str]) -> Iterator[np.ndarray]:
    short = tokenizer.encode([t if len(t) <= CHUNK else "" for t in texts])
    for text, ids in zip(texts, short, strict=True):
        whole = [ids] if len(text) <= CHUNK else [*spliced_ids(tokenizer, text)]
        yield np.concatenate([*whole, np.array([END], np.uint32)])


COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(documents: DataFrame, vocabulary: str, *, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every document is its ids and an end id; pieces lie in the order of the rows, each id in exactly one.
    Sequences are unique over the table: the partition's number and a running number. There is no shuffle,
    and a task holds about one segment of ids and one document. A null or empty text is a document of the
    end id alone; null keys and repeated rows are packed like others; an empty table gives no rows; other
    columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokenizer, stream = byte_tokenizer(vocabulary), None
        marks = sentence_ends(vocabulary)
        for batch in batches:
            for part, texts in text_slices(batch):
                if stream is None:
                    stream = Stream(marks, part.column("part")[0].as_py() << 36, window)
                out: list[tuple] = []
                for k, ids in zip(part.column(key).to_pylist(), _ids(tokenizer, texts), strict=True):
                    stream.add(k, ids)
                    if stream.size >= SEGMENT:
                        out += stream.cut(whole=False)
                yield columns(out)
        if stream:
            yield columns(stream.cut(whole=True))

    def columns(rows: list[tuple]) -> dict:
        turned = [*zip(*rows, strict=True)] or [()] * (len(COLUMNS) + 1)
        return dict(zip((key, *COLUMNS), map(list, turned), strict=True))

    kind = documents.schema[key].dataType.simpleString()
    taken = documents.select(key, "text", F.spark_partition_id().cast("long").alias("part"))
    return map_batches(taken, work, f"{key} {kind}, " + ", ".join(f"{c} long" for c in COLUMNS))
