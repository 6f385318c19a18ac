"""Removal of byte strings that occur more than once, by an index of anchor fingerprints.

Only content-chosen anchors are indexed (see ``anchors``): any two equal strings of ``LENGTH`` bytes hold
anchors with equal heads. The documents come in batches. The index of a batch is the fingerprints of its
distinct heads with their counts; it is joined with every level of the family, which gives the heads that
occur elsewhere too, and is then merged into the family, equal-sized levels becoming one of double size. The
family lives for one call. Anchors with matched heads are extended: anchors whose whole surroundings agree are one class,
and between classes of a head every string of ``LENGTH`` bytes around it is compared by fingerprint. All
comparisons are between fingerprints of 64 bits for heads and 64 more for surroundings or strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.anchors import LENGTH, roll, runs
from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.filters import bitmap, marked, split
from scorewright.llm.shingles import mixed
from scorewright.storage import materialize, materialize_shuffled

#: Batches that the documents of one call are indexed in, and classes of a head that one task compares.
BATCHES, TOGETHER = 4, 1 << 13
#: Bytes of text, and classes, that a task lays out at once: each byte or string takes some 150 bytes meanwhile.
PIECE, CLASSES = 1 << 18, 1 << 10
_CLASS = ["head", "whole", "back", "ahead"]
_SPANS = "array<struct<low:long,high:long>>"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts by their numbers, offsets and bytes, about ``PIECE`` bytes at a time.

    A longer text comes in pieces that overlap by one byte less than a string, so each string is in one piece.
    """
    own: list[int] = []
    offsets: list[int] = []
    raw: list[bytes] = []
    size = 0
    for batch in batches:
        for part, texts in text_slices(batch, budget=PIECE):
            for name, text in zip(part.column("own").to_pylist(), texts, strict=True):
                data = text.encode()
                for at in range(0, max(1, len(data) - LENGTH + 1), PIECE):
                    piece = data[at : at + PIECE + LENGTH - 1]
                    if raw and size + len(piece) > PIECE:
                        yield own, offsets, raw
                        own, offsets, raw, size = [], [], [], 0
                    own.append(name)
                    offsets.append(at)
                    raw.append(piece)
                    size += len(piece)
    if raw:
        yield own, offsets, raw


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for own, offsets, raw in _pieces(batches):
        found = runs(roll(raw))
        at = found.anchor + np.array(offsets, np.int64)[found.row]
        yield {"own": np.array(own, np.int64)[found.row], "anchor": at, "back": found.back, "ahead": found.ahead, "head": found.head.view(np.int64), "whole": found.whole.view(np.int64)}


def _only_marked(bits: np.ndarray, column: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            kept = batch.filter(pa.array(marked(bits, batch.column(column).to_numpy())))
            yield {c: kept.column(c) for c in kept.schema.names}

    return work


def suffix_array(entries: DataFrame) -> DataFrame:
    """The distinct heads of a batch by fingerprint, with the number of anchors of each; no order of suffixes."""
    return materialize_shuffled(entries.groupBy("head").agg(F.count("*").alias("n")).sortWithinPartitions("head"))


class IndexFamily:
    """Levels of the index; level k holds about 2**k batches. Matched heads gather in ``matches``."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}
        self.matches: list[DataFrame] = []

    def add(self, array: DataFrame) -> None:
        self.matches.append(array.where("n > 1").select("head"))
        for level in self.levels.values():
            self.matches.append(array.select("head").join(level.select("head"), "head", "left_semi"))
        k = 0
        while k in self.levels:
            both = self.levels.pop(k).unionByName(array)
            array = materialize_shuffled(both.groupBy("head").agg(F.sum("n").alias("n")).sortWithinPartitions("head"))
            k += 1
        self.levels[k] = array

    def matched(self) -> DataFrame:
        found = self.matches[0]
        for more in self.matches[1:]:
            found = found.unionByName(more)
        return materialize_shuffled(found.distinct())


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The bytes around each wanted anchor of a text."""
    for batch in batches:
        for part, texts in text_slices(batch, budget=PIECE):
            out: tuple[list, ...] = ([], [], [], [], [])
            for text, places in zip(texts, part.column("wanted").to_pylist(), strict=True):
                raw = text.encode()
                for w in places:
                    for column, value in zip(out, (w["head"], w["id"], w["n"], w["back"], raw[w["anchor"] - w["back"] : w["anchor"] + w["ahead"] + LENGTH]), strict=True):
                        column.append(value)
            yield dict(zip(("head", "id", "n", "back", "bytes"), out, strict=True))


def _strings(table: dict[str, list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of classes: for each of their strings the class's row, its start before the anchor, and its key."""
    rolling = roll(table["bytes"])
    counts = np.diff(rolling.bounds) - LENGTH + 1
    row = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = rolling.bounds[row] + inside
    before = np.array(table["back"], np.int64)[row] - inside
    key = mixed(rolling.spans(start, start + LENGTH) + before.astype(np.uint64))
    return row, before, key


def _spans(before: np.ndarray) -> list[dict]:
    """What strings that start so many bytes before an anchor cover, relative to it."""
    starts = np.sort(-before)
    cut = np.flatnonzero(np.diff(starts) > LENGTH) + 1
    return [{"low": int(p[0]), "high": int(p[-1]) + LENGTH} for p in np.split(starts, cut)]


def _compare(classes: pa.Table) -> dict:
    """Classes of whole heads: the spans of their strings that occur elsewhere. Only a few bytes of each string are held together."""
    rows, places, keys = [], [], []
    for at in range(0, classes.num_rows, CLASSES):
        part = classes.slice(at, CLASSES).select(["head", "back", "bytes"]).to_pydict()
        row, before, key = _strings(part)
        keys.append(mixed(key ^ mixed(np.array(part["head"], np.int64).view(np.uint64)[row])))
        rows.append((row + at).astype(np.int32))
        places.append(before.astype(np.int32))
        del part, row, before, key
    row, before = np.concatenate(rows), np.concatenate(places)
    codes, _ = pd.factorize(np.concatenate(keys))
    totals = np.bincount(codes, weights=classes.column("n").to_numpy().astype(float)[row])
    again = totals[codes] > 1
    row, before = row[again], before[again].astype(np.int64)
    cut = np.flatnonzero(np.diff(row)) + 1
    ids = classes.column("id").to_numpy()[row[np.concatenate([[0], cut])]].tolist() if len(row) else []
    return {"id": ids, "spans": [_spans(p) for p in np.split(before, cut)] if len(row) else []}


def _compare_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Classes sorted by head: compared in batches of whole heads, about ``CLASSES`` at a time or one larger head."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        heads = table.column("head").to_numpy()
        begins = np.concatenate([[0], np.flatnonzero(np.diff(heads)) + 1])
        done = 0
        while done < begins[-1]:
            more = int(max(begins[begins <= done + CLASSES][-1], begins[begins > done][0]))
            yield _compare(table.slice(done, more - done))
            done = more
        held = table.slice(done)
    if held is not None:
        yield _compare(held)


def _explode_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, CLASSES):
            table = batch.slice(at, CLASSES).to_pydict()
            row, before, key = _strings(table)
            yield {"head": np.array(table["head"])[row], "key": key.view(np.int64), "id": np.array(table["id"])[row], "n": np.array(table["n"])[row], "before": before}


def _removed(columns: list[str], digest: bool, touched: np.ndarray | None = None):
    """Texts without their ``spans``; given a bitmap, only those that it does not mark, whole."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if touched is not None:
                batch = batch.filter(pa.array(~marked(touched, batch.column("own").to_numpy())))
            for part, texts in text_slices(batch):
                spans = part.column("spans").to_pylist() if touched is None else [None] * len(texts)
                out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
                for text, own in zip(texts, spans, strict=True):
                    raw = text.encode()
                    kept, at, n = [], 0, 0
                    for low, high in merged(own or []):
                        kept.append(raw[at:low])
                        at, n = high, n + 1
                    kept.append(raw[at:])
                    rest = b"".join(kept)
                    out["n_bytes"].append(len(raw))
                    out["n_removed"].append(len(raw) - len(rest))
                    out["n_spans"].append(n)
                    out["kept_sha256"].append(hashlib.sha256(rest).hexdigest() if digest else None)
                    out["kept"].append(None if digest else rest.decode(errors="ignore"))
                yield {c: part.column(c) for c in columns} | out

    return work


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch, in order."""
    out: list[tuple[int, int]] = []
    for s in sorted(spans, key=lambda s: s["low"]):
        if out and s["low"] <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], s["high"])
        else:
            out.append((s["low"], s["high"]))
    return out


def repeated_spans(texts: DataFrame, *, batches: int = BATCHES) -> DataFrame:
    """``own, spans`` of every text of ``own, text`` that holds a repeated string; equal texts have equal ``own``."""
    entries = materialize(map_batches(texts, _entries, "own long, anchor long, back short, ahead short, head long, whole long"))
    family = IndexFamily()
    for i in range(batches):
        family.add(suffix_array(entries.where(F.pmod("own", F.lit(batches)) == i)))
    matched = family.matched()
    near = map_batches(entries, _only_marked(bitmap(matched, "head"), "head"), "own long, anchor long, back short, ahead short, head long, whole long")
    found = materialize_shuffled(near.join(matched, "head", "left_semi"))
    classes = found.groupBy(*_CLASS).agg(F.count("*").alias("n"), F.min(F.struct("own", "anchor")).alias("at"))
    classes = materialize_shuffled(classes.withColumn("id", F.monotonically_increasing_id()))
    per_head = classes.groupBy("head").agg(F.count("*").alias("classes")).where("classes > 1")

    # Classes that share a head with others: their surroundings, from one text of each.
    shared = classes.join(per_head, "head").withColumn("own", F.col("at.own"))
    wanted = materialize_shuffled(shared.groupBy("own").agg(F.collect_list(F.struct("head", "id", "n", "back", "ahead", F.col("at.anchor").alias("anchor"))).alias("wanted")))
    holders = map_batches(texts, _only_marked(bitmap(wanted, "own"), "own"), "own long, text string").dropDuplicates(["own"])
    context = map_batches(holders.join(wanted, "own").select("text", "wanted"), _surroundings, "head long, id long, n long, back short, bytes binary")
    context = materialize_shuffled(context.join(per_head, "head"))
    few = context.where(F.col("classes") <= TOGETHER).drop("classes").repartition("head").sortWithinPartitions("head")
    spans = map_batches(few, _compare_sorted, f"id long, spans {_SPANS}")
    many = map_batches(context.where(F.col("classes") > TOGETHER).drop("classes"), _explode_strings, "head long, key long, id long, n long, before long")
    if not per_head.where(F.col("classes") > TOGETHER).isEmpty():
        many = materialize(many)
        again = many.groupBy("head", "key").agg(F.sum("n").alias("n")).where("n > 1").select("head", "key")
        covered = many.join(again, ["head", "key"], "left_semi").select("id", F.explode(F.array(F.struct((-F.col("before")).alias("low"), (LENGTH - F.col("before")).alias("high")))).alias("span"))
        spans = spans.unionByName(covered.groupBy("id").agg(F.collect_list("span").alias("spans")))
    alone = classes.join(per_head, "head", "left_anti").where("n > 1").select("id", F.array(F.struct((-F.col("back")).cast("long").alias("low"), (F.col("ahead") + LENGTH).cast("long").alias("high"))).alias("spans"))
    spans = materialize_shuffled(spans.unionByName(alone))

    placed = found.select("own", "anchor", *_CLASS).distinct().join(classes.select(*_CLASS, "id"), _CLASS).join(spans, "id")
    moved = F.transform("spans", lambda s: F.struct((s.low + F.col("anchor")).alias("low"), (s.high + F.col("anchor")).alias("high")))
    return materialize_shuffled(placed.groupBy("own").agg(F.flatten(F.collect_list(moved)).alias("spans")))


def remove_repeated(documents: DataFrame, *, key: str = "doc_id", carry: tuple[str, ...] = (), digest: bool = True, batches: int = BATCHES) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans`` of every row with ``kept_sha256``, or with ``kept`` if not ``digest``.

    A byte goes if a string of 200 bytes that covers it starts anywhere else too, in the same text or another
    row's, as the texts were given. ``kept`` drops what a cut left of a character. Null and empty texts and
    those of under 200 bytes lose nothing; repeated rows repeat each other; null keys are kept; an empty table
    gives no rows; other columns are read only if named in ``carry``. Texts of any length are cut whole.
    """
    fields = {f.name: f.dataType.simpleString() for f in documents.schema}
    columns = [key, *[c for c in carry if c != key]]
    rows = documents.select(*columns, *["text"] * ("text" not in columns)).withColumn("own", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = repeated_spans(rows.where("octet_length(text) >= 200").select("own", "text"), batches=batches)
    bits = bitmap(found, "own")
    names = [*dict.fromkeys([*columns, "text", "own"])]
    touched, _ = split(rows.select(*names), bits, "own")
    out = ", ".join(f"`{c}` {fields[c]}" for c in columns) + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
    removed = map_batches(touched.join(found, "own", "left").select(*names, "spans"), _removed(columns, digest), out)
    removed = removed.unionByName(map_batches(rows.select(*names), _removed(columns, digest, bits), out))
    return removed.drop("kept" if digest else "kept_sha256")
