"""Spelling variants: words one edit apart, found by joining search states with the edges of a trie.

Words are counted in tasks and put into two tries, one of the words and one of the words read backwards. An
edit in the second half of a word leaves its first half as it is, so the search for such edits begins at the
trie node of the first half; edits in the first half are those of the second half of the word read backwards.
No search begins near the root, where a node has the whole vocabulary below it.

A trie is a table of edges (parent, label, child): nodes are named by fingerprints of their prefixes, and
chains without a branch or an end of a word are one edge. A state (word, position, node, edits) is joined
with the edges of its node: without an edit yet with all of them, after the edit with the one that begins
with the word's next character. States advance level by level until none is left; a state that has made its
edit and used up its word at the end of another word is a pair of neighbours.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.pieces import lay_out, span_hashes
from scorewright.storage import discard, materialize

#: A run whose checksum this number divides loses a character.
DAMAGED = 199
#: Code points of a run up to which checksums are computed for all runs at once.
_SHORT = 64
#: Bytes of states, about, up to which a level is sent to all tasks. Other joins merge, whatever Spark takes a table's size to
#: be: it goes by compressed files, and does not know how many rows a batch function or an explode makes of one.
SENT = 4 << 20


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ 0xEDB88320, table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def checksums(prefixes: np.ndarray, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of letters below U+0100 in UTF-8, carried on from the checksum of what is before it."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(-sizes, kind="stable")
    long = int((sizes > _SHORT).sum())
    for i in order[:long].tolist():
        out[i] = zlib.crc32(codes[starts[i] : starts[i] + sizes[i]].astype(np.uint8).tobytes().decode("latin-1").encode(), int(prefixes[i]))
    order = order[long:]
    state, begin, n = prefixes[order] ^ np.uint32(0xFFFFFFFF), starts[order], sizes[order]
    for k in range(int(n[0]) if len(n) else 0):
        live = int(np.searchsorted(-n, -k))
        own, now = codes[begin[:live] + k], state[:live]
        wide = np.flatnonzero(own >= 0x80)
        if len(wide):
            now[wide] = _TABLE[(now[wide] ^ 0xC3) & 0xFF] ^ now[wide] >> 8
        low = np.where(own >= 0x80, own - 0x40, own)
        state[:live] = _TABLE[(now ^ low) & 0xFF] ^ now >> 8
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _counted(keys: list, texts: list[str], shortest: int) -> tuple[list[str], list[int]]:
    """Distinct words of a slice of texts and how often each occurs."""
    layout = lay_out(texts)
    codes = layout.codes.copy()
    codes[(codes >= 0x41) & (codes <= 0x5A)] += 32
    letter = (codes >= 0x61) & (codes <= 0x7A) | (codes >= 0xC0) & (codes <= 0xFF)
    before = np.zeros(len(codes), bool)
    before[1:] = letter[:-1]
    before[layout.bounds[:-1][layout.bounds[:-1] < len(codes)]] = False
    starts = np.flatnonzero(letter & ~before)
    after = np.append(~letter | (letter & ~before), True)  # where a run cannot go on
    stops = np.flatnonzero(after)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    kept = ends - starts >= shortest
    starts, sizes = starts[kept], (ends - starts)[kept]
    if not len(starts):
        return [], []
    rows = np.searchsorted(layout.bounds, starts, side="right") - 1
    prefixes = np.array([zlib.crc32(f"{'' if k is None else k}:".encode()) for k in keys], np.uint32)
    sums = checksums(prefixes[rows], codes, starts, sizes)
    hit = sums % DAMAGED == 0
    lowered = codes.astype("<u4").tobytes()
    counts: dict[str, int] = {}
    for a, n, h in zip(starts[hit].tolist(), sizes[hit].tolist(), sums[hit].tolist(), strict=True):
        if n > shortest:
            word = lowered[4 * a : 4 * (a + n)].decode("utf-32-le")
            word = word[: h % n] + word[h % n + 1 :]
            counts[word] = counts.get(word, 0) + 1
    starts, sizes = starts[~hit], sizes[~hit]
    _, first, number = np.unique(span_hashes(codes, starts, starts + sizes), return_index=True, return_counts=True)
    words = [lowered[4 * a : 4 * (a + n)].decode("utf-32-le") for a, n in zip(starts[first].tolist(), sizes[first].tolist(), strict=True)]
    return words + list(counts), number.tolist() + list(counts.values())


def word_counts(documents: DataFrame, *, key: str = "doc_id", shortest: int = 6, least: int = 5) -> DataFrame:
    """``word, n``: words of at least ``shortest`` code points that occur at least ``least`` times, see the README.

    A null text has no words; a null key counts as an empty one in checksums; texts of any length are read
    whole; repeated rows count again.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part, texts in text_slices(batch):
                words, numbers = _counted(part.column(key).to_pylist(), texts, shortest)
                if words:
                    yield {"word": words, "n": numbers}

    return map_batches(documents.select(key, "text"), work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(27)


def _prefixes(strings: DataFrame, floor: int) -> DataFrame:
    """One row for each prefix of ``floor`` characters or more of ``x``: its node's 128-bit name and the next character."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part, texts in text_slices(batch, "x", 1 << 18):
                layout = lay_out(texts)
                sizes = np.diff(layout.bounds)
                count = sizes - floor + 1
                row = np.repeat(np.arange(len(texts)), count)
                pos = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + floor
                begin = layout.bounds[:-1][row]
                back = part.column("back").to_numpy(zero_copy_only=False)[row]
                a = span_hashes(layout.codes, begin, begin + pos) ^ np.where(back, np.uint64(0xD6E8FEB86659FD93), np.uint64(0))
                b = span_hashes(_mixed(layout.codes), begin, begin + pos)
                ends = pos == sizes[row]
                follows = layout.codes[np.minimum(begin + pos, len(layout.codes) - 1)].astype(np.int64)
                taken = pa.array(row)
                yield {
                    "back": part.column("back").take(taken), "x": part.column("x").take(taken), "pos": pos, "a": a.view(np.int64), "b": b.view(np.int64),
                    "follows": pa.array(follows, mask=ends), "n": pa.array(part.column("n").to_numpy()[row], mask=~ends),
                }

    return map_batches(strings, work, "back boolean, x string, pos int, a long, b long, follows long, n long")


def _trie(strings: DataFrame, floor: int) -> DataFrame:
    """Each string with the nodes on its path that branch, end a word or are ``floor`` deep, in order."""
    prefixes = _prefixes(strings, floor)
    bit = F.expr("shiftleft(1L, cast(follows % 64 as int))")
    nodes = prefixes.groupBy("a", "b").agg(F.min("pos").alias("depth"), F.min("follows").alias("low"), F.max("follows").alias("high"), F.bit_or(bit).alias("mask"), F.max("n").alias("n_end"))
    nodes = nodes.where(f"n_end is not null or low <> high or depth = {floor}").select("a", "b", F.coalesce("mask", F.lit(0)).alias("mask"), "n_end")
    on_path = prefixes.select("back", "x", "pos", "a", "b").join(nodes.hint("merge"), ["a", "b"])
    return on_path.groupBy("back", "x").agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "mask", "n_end"))).alias("path"))


_EDGES = """inline(transform(sequence(1, size(path) - 1), i -> struct(
  path[i - 1].a as a, path[i - 1].b as b, substring(x, path[i - 1].pos + 1, path[i].pos - path[i - 1].pos) as label,
  path[i].a as to_a, path[i].b as to_b, path[i].mask as mask, path[i].n_end as n_end,
  if(path[i].n_end is null, null, left(x, path[i].pos)) as whole)))"""

#: What reading a label does to a state: characters of the word used up, and edits. Equal labels cost nothing and
#: then no edit is tried inside them: an edit that also fits there fits behind them, too.
_READ = """case when startswith(rest, label) then array(struct(m as used, edits as made))
  when edits = 1 then array()
  else filter(array(
    if(length(rest) >= m and levenshtein(left(rest, m), label, 1) = 1, struct(m as used, 1 as made), null),
    if(levenshtein(left(rest, m - 1), label, 1) = 1, struct(m - 1 as used, 1 as made), null),
    if(length(rest) > m and levenshtein(left(rest, m + 1), label, 1) = 1, struct(m + 1 as used, 1 as made), null)), s -> s is not null) end"""


def near_words(words: DataFrame, *, shortest: int = 6) -> DataFrame:
    """``word, near, n``: every ordered pair of words of ``words`` (``word, n``; distinct) that differ by exactly
    one inserted, deleted or replaced code point, with the ``n`` of ``near``.

    All words must have at least ``shortest`` code points. The result is written to the shared folder.
    """
    floor = shortest // 2
    strings = words.select("word", "n").selectExpr("n", "inline(array(struct(false as back, word as x), struct(true as back, reverse(word) as x)))")
    paths = materialize(_trie(strings, floor))
    edges = materialize(paths.select(F.expr(_EDGES)).dropDuplicates(["to_a", "to_b"]).withColumn("first", F.expr("left(label, 1)")))
    half = "if(back, length(x) - length(x) div 2, length(x) div 2)"
    begin = paths.withColumn("at", F.expr(f"element_at(filter(path, p -> p.pos <= {half}), -1)"))
    states = begin.select("back", "x", F.col("at.pos").alias("pos"), F.col("at.a").alias("a"), F.col("at.b").alias("b"), F.lit(0).alias("edits"))
    # a word of two or three characters may end right behind the node that its search begins at
    found = [begin.where("at.n_end is not null and length(x) - at.pos = 1").selectExpr("if(back, reverse(x), x) as word", "if(back, reverse(left(x, at.pos)), left(x, at.pos)) as near", "at.n_end as n")]
    old, level, how = [paths], None, "merge"
    while True:
        unread = "substring(x, pos + 1)"
        fresh = states.where("edits = 0").hint(how).join(edges, ["a", "b"])
        made = states.where("edits = 1").withColumn("first", F.expr("substring(x, pos + 1, 1)")).hint(how).join(edges, ["a", "b", "first"])
        columns = ["back", "x", "pos", "edits", "label", "to_a", "to_b", "mask", "n_end", "whole"]
        met = (fresh if level is None else fresh.select(columns).unionByName(made.select(columns))).select(*columns, F.expr(f"{unread} as rest"), F.expr("length(label) as m"))
        read = met.select("back", "x", "pos", "to_a", "to_b", "mask", "n_end", "whole", F.expr(f"inline({_READ})"))
        read = read.select("back", "x", (F.col("pos") + F.col("used")).alias("pos"), F.col("to_a").alias("a"), F.col("to_b").alias("b"), F.col("made").alias("edits"), "mask", "n_end", "whole")
        left = "(length(x) - pos)"
        ends = F.expr(f"n_end is not null and {left} + edits = 1")
        goes_on = F.expr(f"edits = 0 and mask <> 0 or {left} > 0 and (mask & shiftleft(1L, ascii_of % 64)) <> 0")
        read = read.withColumn("ascii_of", F.expr("ascii(substring(x, pos + 1, 1))"))
        level = materialize(read.select("back", "x", "pos", "a", "b", "edits", "n_end", "whole", ends.alias("ends"), goes_on.alias("goes_on")).where("ends or goes_on"))
        found.append(level.where("ends").selectExpr("if(back, reverse(x), x) as word", "if(back, reverse(whole), whole) as near", "n_end as n"))
        old.append(level)
        states = level.where("goes_on").select("back", "x", "pos", "a", "b", "edits")
        size = states.agg(F.expr("sum(64 + octet_length(x))")).first()[0]
        if size is None:
            break
        how = "broadcast" if size <= SENT else "merge"
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    pairs = materialize(pairs.where("levenshtein(word, near, 1) = 1").distinct())
    discard(*old, edges)
    return pairs


def spelling_variants(words: DataFrame, *, ratio: int = 5, shortest: int = 6) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``words`` (``word, n``).

    ``form`` is the near word of largest ``n`` (ties: the first in code-point order) if that is at least
    ``ratio`` times the word's own, else null; ``root`` follows forms to the last and is the word itself if it
    has none. Forms grow by ``ratio`` at each step, so chains are short and have no circles. An empty table
    gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be above 1, or forms could go round in circles")
    words = materialize(words.select("word", "n"))
    pairs = near_words(words, shortest=shortest)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    near = words.join(best.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr(f"if(-best.minus >= {ratio} * n, struct(best.near as form, -best.minus as form_n), null) as f"))
    near = materialize(near.select("word", "n", "n_near", "f.form", "f.form_n"))
    roots = near.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps that a root is away
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        jumped = materialize(roots.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        roots = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            break
    return near.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
