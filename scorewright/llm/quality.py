"""Document quality: histogram gradient-boosted trees over statistics of whole texts.

The trees are fitted on a bounded sample of labelled documents and flattened into arrays, one row per tree,
which tasks walk for all documents of a slice at once. Only statistics of the text are inputs.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.pieces import lay_out, span_hashes

#: Labelled documents that are fitted on (expected number; all of them while there are fewer).
SAMPLE = 40_000
TREES, DEPTH, BINS, RATE, PENALTY, SMALLEST = 80, 4, 64, 0.15, 1.0, 20.0
#: Documents with this score or more are good.
GOOD = 0.3

# Kinds of characters.
_UNSEEN, LOWER, UPPER, OTHER_LETTER, DIGIT, BLANK, LINE, STOP, PAUSE, QUOTE, BRACKET, SYMBOL, REST = range(13)
_KINDS = 13
_kinds = np.zeros(0x110000, np.uint8)


def _kind_of(c: str) -> int:
    if c.islower():
        return LOWER
    if c.isupper():
        return UPPER
    if c.isalpha():
        return OTHER_LETTER
    if c.isdigit():
        return DIGIT
    if c in "\n\r":
        return LINE
    if c.isspace():
        return BLANK
    if c in ".?":
        return STOP
    if c in ",;:":
        return PAUSE
    if c in "'\"":
        return QUOTE
    if c in "()[]{}<>":
        return BRACKET
    return SYMBOL if unicodedata.category(c)[0] in "PS" else REST


def _kinds_of(codes: np.ndarray) -> np.ndarray:
    found = _kinds[codes]
    if not found.all():
        for x in np.unique(codes[found == _UNSEEN]):
            _kinds[x] = _kind_of(chr(x))
        found = _kinds[codes]
    return found


def _spans(inside: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked characters, cut where a text begins."""
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    starts = np.flatnonzero(inside & (~before | first))
    after = np.concatenate([~inside[1:] | first[1:], [True]]) if len(inside) else inside
    return starts, np.flatnonzero(inside & after) + 1


def _repeats(keys: np.ndarray, rows: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Weight of each row's keys that occurred in the same row before."""
    own = keys ^ (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    again = pd.Series(own).duplicated().to_numpy()
    return np.bincount(rows[again], weights=weights[again], minlength=n)


NAMES = (
    *(f"share_{i}" for i in range(1, _KINDS)),
    "characters", "words", "lines", "word_length", "word_length_spread", "words_per_line",
    "repeated_words", "repeated_triples", "repeated_lines", "short_words", "long_words",
    "letter_to_symbol", "symbol_to_symbol", "symbol_words", "upper_runs", "stops_per_word", "lower_words", "distinct_kinds",
)


def features(texts: list[str]) -> np.ndarray:
    """One row of statistics per text, in the order of ``NAMES``; an empty text has zeros."""
    n = len(texts)
    out = np.zeros((n, len(NAMES)))
    layout = lay_out(texts)
    codes, first = layout.codes, layout.first
    if not len(codes):
        return out
    kinds = _kinds_of(codes)
    sizes = np.diff(layout.bounds)
    row_of = np.repeat(np.arange(n), sizes)
    counts = np.bincount(row_of * _KINDS + kinds, minlength=n * _KINDS).reshape(n, _KINDS)
    size = np.maximum(sizes, 1)
    columns = [counts[:, i] / size for i in range(1, _KINDS)]

    starts, ends = _spans((kinds != BLANK) & (kinds != LINE), first)
    rows = row_of[starts]
    lengths = ends - starts
    words = np.bincount(rows, minlength=n)
    some = np.maximum(words, 1)
    line_starts, line_ends = _spans(kinds != LINE, first)
    line_rows = row_of[line_starts]
    lines = np.bincount(line_rows, minlength=n)
    mean = np.bincount(rows, weights=lengths, minlength=n) / some
    spread = np.sqrt(np.maximum(np.bincount(rows, weights=lengths.astype(float) ** 2, minlength=n) / some - mean**2, 0))
    hashes = span_hashes(codes, starts, ends)
    one = np.ones(len(rows))
    columns += [np.log1p(sizes), np.log1p(words), np.log1p(lines), mean, spread, words / np.maximum(lines, 1)]
    columns.append(_repeats(hashes, rows, one, n) / some)
    if len(rows) > 2:
        same = rows[2:] == rows[:-2]
        triple = (hashes[2:] * np.uint64(3) + hashes[1:-1] * np.uint64(0x9E3779B1) + hashes[:-2] * np.uint64(0xC2B2AE3D27D4EB4F))[same]
        columns.append(_repeats(triple, rows[2:][same], np.ones(len(triple)), n) / some)
    else:
        columns.append(np.zeros(n))
    columns.append(_repeats(span_hashes(codes, line_starts, line_ends), line_rows, (line_ends - line_starts).astype(float), n) / size)
    share = lambda marks: np.bincount(rows[marks], minlength=n) / some
    columns += [share(lengths <= 2), share(lengths >= 12)]
    begin, last = kinds[starts], kinds[ends - 1]
    letter = (kinds == LOWER) | (kinds == UPPER) | (kinds == OTHER_LETTER)
    symbol = kinds == SYMBOL
    inner = ~first[1:]
    pairs = lambda marks: np.bincount(row_of[1:][marks & inner], minlength=n) / some
    columns += [pairs(letter[:-1] & symbol[1:]), pairs(symbol[:-1] & symbol[1:]), share((begin == SYMBOL) & (last == SYMBOL)), pairs((kinds[:-1] == UPPER) & (kinds[1:] == UPPER))]
    columns += [share(last == STOP), share((begin == LOWER) & (last == LOWER)), (counts > 0).sum(axis=1)]
    return np.where(sizes[:, None] > 0, np.column_stack(columns), 0.0)


@dataclass
class Model:
    """Complete trees as arrays: ``feature`` and ``threshold`` of inner nodes, ``value`` of leaves, a row per tree."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Model:
    """Boosted trees of logistic loss on histograms of gradients. Without rows or with one class: a constant."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Model(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) for j in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    cells = binned + np.arange(width) * BINS
    trees, total = [], np.full(len(y), start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for depth in range(DEPTH):
            low, here = 2**depth - 1, 2**depth
            index = ((node - low)[:, None] * (width * BINS) + cells).ravel()
            g, h = (np.bincount(index, weights=np.repeat(v, width), minlength=here * width * BINS).reshape(here, width, BINS) for v in (gradient, weight))
            gl, hl = g.cumsum(2), h.cumsum(2)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gr, hr = gt - gl, ht - hl
            gain = gl**2 / (hl + PENALTY) + gr**2 / (hr + PENALTY) - gt**2 / (ht + PENALTY)
            enough = SMALLEST / 4
            gain[(hl < enough) | (hr < enough)] = 0
            best = gain.reshape(here, -1).argmax(1)
            for k, cell in enumerate(best.tolist()):
                j, b = divmod(cell, BINS)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[low + k], threshold[low + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, weights=gradient, minlength=leaves) / (np.bincount(leaf, weights=weight, minlength=leaves) + PENALTY)
        total += value[leaf]
        trees.append((feature, threshold, value))
    return Model(start, *(np.array(part) for part in zip(*trees, strict=True)))


def held_out(key: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` labelled documents that are not held out, chosen by a hash of their key.

    Several labels of a key are averaged, of several rows of a key one counts; null keys and labels are
    left out. The driver receives one row of statistics per sampled key, never texts.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key)).groupBy(key).agg(F.avg(label).alias("wanted"))
    share = sample / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(share * 1_000_000))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part, texts in text_slices(batch):
                yield {key: part.column(key), "wanted": part.column("wanted"), "features": list(features(texts))}

    kind = documents.schema[key].dataType.simpleString()
    joined = documents.select(key, "text").join(F.broadcast(known), key)
    rows = map_batches(joined, work, f"{key} {kind}, wanted double, features array<double>").groupBy(key, "wanted").agg(F.min("features").alias("features")).toArrow()
    if not rows.num_rows:
        return fit_trees(np.zeros((0, len(NAMES))), np.zeros(0))
    rows = rows.sort_by(key)
    x = rows.column("features").combine_chunks().flatten().to_numpy().reshape(-1, len(NAMES))
    return fit_trees(x, rows.column("wanted").to_numpy())


def score(documents: DataFrame, model: Model, *, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, held_out, score, predicted`` and the columns of ``carry`` for every row, without a shuffle.

    Null and empty texts are scored like others, by statistics that are all zero; null keys and repeated
    rows are kept; an empty table gives no rows; the columns that are not carried are not read. Texts of any
    length are read whole, one slice of them at a time.
    """
    fields = {f.name: f.dataType.simpleString() for f in documents.schema}
    carried = [c for c in carry if c != key]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part, texts in text_slices(batch):
                found = model.scores(features(texts))
                yield {c: part.column(c) for c in (key, *carried)} | {"held_out": part.column("is_held_out"), "score": found, "predicted": (found >= GOOD).astype(np.int32)}

    taken = documents.select(key, "text", *[c for c in carried if c != "text"], held_out(key).alias("is_held_out"))
    schema = ", ".join(f"`{c}` {fields[c]}" for c in (key, *carried)) + ", held_out boolean, score double, predicted int"
    return map_batches(taken, work, schema)
