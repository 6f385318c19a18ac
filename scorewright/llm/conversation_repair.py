"""Repair of conversations: faulty rows are found, and the roles are mended at least cost (see role_grammar).

A conversation is read by one task if it is small. A large one may hold a third of all rows, so it is cut:
its rows are sorted in ranges over many tasks, repeated texts are found by grouping, every segment gives for
each stack top it may begin with the tops it can end with, these few numbers are folded along the segments,
and then each segment writes its own edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches
from scorewright.llm.filters import bitmap, split
from scorewright.llm.role_grammar import COST, DELETE, EMPTY, INSERT, KEEP, TRUNCATED, Parser, Row, Stack, alone, closing, turns
from scorewright.storage import materialize

#: Bytes of a conversation up to which one task reads it whole, and code points of a text that ranges go by.
LARGE, RANGED = 16 << 20, 64
_WHITE, _ENDS = " \t\n\x0b\x0c\r", ".!?"
_LEGAL = {"su", "ua", "au"}
_KEYS = ("conv_id", "turn", "role", "text")


def _fault(text: str) -> str | None:
    """Blank, or truncated by the last character that is no white space, or neither."""
    seen = text.rstrip(_WHITE)
    return "blank" if not seen else None if seen[-1] in _ENDS else "truncated"


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Equal rows of a batch as one row and their number: what a hot row is before any shuffle."""
    for batch in batches:
        counted = pa.Table.from_batches([batch]).group_by(list(_KEYS)).aggregate([([], "count_all")])
        yield {c: counted.column(c).combine_chunks() for c in _KEYS} | {"n": counted.column("count_all").combine_chunks()}


_NAMES = ("conv_id", "place", "step", "turn", "fault", "illegal", "edit", "times", "role", "text", "cost")
_EDITS = "place long, step int, turn {turn}, fault string, illegal long, edit string, times long, role string, text string, cost long"


class _Writer:
    """Edits of the rows of one conversation or segment, in order."""

    def __init__(self, conv: object, before: str | None):
        self.conv, self.before = conv, before
        self.out: list[tuple] = []

    def row(self, place: int, turn: object, initial: str, fault: str | None, n: int, letters: str, roles: list[str | None], said: tuple[str, str] | None, truncated: bool) -> None:
        pairs = int(self.before is not None and self.before + initial not in _LEGAL)
        repeats = (n - 1) * int(initial + initial not in _LEGAL)
        self.before = initial
        for k, (letter, role) in enumerate(zip(letters, roles, strict=True)):
            if letter == INSERT:
                self._add(place, k, None, None, 0, INSERT, 1, role, "", COST[INSERT])
        letter, role = letters[-1], roles[-1]
        cost = COST[letter] + truncated * TRUNCATED * (letter != DELETE)
        if fault in ("blank", "duplicate"):
            self._add(place, len(letters), turn, fault, pairs + repeats, DELETE, n, None, None, n * COST[DELETE])
            return
        kept = (None, None) if letter == DELETE else (role or (said and said[0]), said and said[1])
        self._add(place, len(letters), turn, fault, pairs, letter, 1, *kept, cost)
        if n > 1:
            self._add(place, len(letters) + 1, turn, "duplicate", repeats, DELETE, n - 1, None, None, (n - 1) * COST[DELETE])

    def close(self, place: int, roles: list[str]) -> None:
        for k, role in enumerate(roles):
            self._add(place, k, None, None, 0, INSERT, 1, role, "", COST[INSERT])

    def _add(self, *values: object) -> None:
        self.out.append((self.conv, *values))


def _repair_whole(parser: Parser, conv: object, rows: list[tuple]) -> list[tuple]:
    """Edits of one conversation whose sorted rows (turn, role, text, n) are all here."""
    stack, seen, faults = Stack(parser), set(), []
    for _, role, text, n in rows:
        fault = _fault(text)
        fault = "duplicate" if fault != "blank" and (role, text) in seen else fault
        seen.add((role, text))
        faults.append(fault)
        stack.read(Row(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    _, top, inserts = parser.end(stack.tops)
    letters = stack.letters(top)
    initials = [role[:1] for _, role, _, _ in rows]
    writer = _Writer(conv, None)
    for i, ((turn, role, text, n), fault, own, new) in enumerate(zip(rows, faults, letters, turns(letters, initials, EMPTY), strict=True)):
        writer.row(i, turn, role[:1], fault, n, own, new, (role, text), fault == "truncated")
    writer.close(len(rows), closing(top, inserts))
    return writer.out


def _streams(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], key: int) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Rows of a sorted task, one stream for each run of the first ``key`` columns."""
    rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in columns], strict=True))
    return groupby(rows, key=lambda r: r[:key])


def _batched(rows: Iterator[tuple], names: tuple[str, ...], size: int = 4096) -> Iterator[dict]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield dict(zip(names, map(list, zip(*held, strict=True)), strict=True))
            held = []
    if held:
        yield dict(zip(names, map(list, zip(*held, strict=True)), strict=True))


def _edits_of_small(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    parser = Parser()
    streams = _streams(batches, (*_KEYS, "n"), 1)
    yield from _batched((e for (conv,), rows in streams for e in _repair_whole(parser, conv, [r[1:] for r in rows])), _NAMES)


_MARKED = ("conv_id", "seg", "pos", "turn", "initial", "fault", "n")


def _row(initial: str, fault: str | None) -> Row:
    return Row(initial, fault in ("blank", "duplicate"), fault == "truncated")


def _segment_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """For each segment, the cost and rank of every top that each top it may begin with leads to."""
    parser = Parser()

    def tables() -> Iterator[tuple]:
        for (conv, seg), rows in _streams(batches, _MARKED, 2):
            tops, costs, first, last = [alone(t) for t in range(4)], [0] * 4, None, None
            for _, _, _, _, initial, fault, _ in rows:
                first = initial if first is None else first
                last = initial
                row = _row(initial, fault)
                for t in range(4):
                    if row.delete:
                        costs[t] += COST[DELETE]
                    else:
                        tops[t], more, _ = parser.step(tops[t], row.initial, row.truncated)
                        costs[t] += more
            found = [h and (h[0] + costs[t], h[1]) for t in range(4) for h in tops[t]]
            yield conv, seg, [f and f[0] for f in found], [f and f[1] for f in found], last

    return _batched(tables(), ("conv_id", "seg", "costs", "ranks", "last"))


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Fold the segments of each conversation: which tops the best parse begins and ends each of them with."""
    parser = Parser()

    def choices() -> Iterator[tuple]:
        for (conv,), segments in _streams(batches, ("conv_id", "seg", "costs", "ranks", "last"), 1):
            tops, backs, names, before = alone(EMPTY), [], [], None
            for _, seg, costs, ranks, last in segments:
                best: dict[int, tuple] = {}
                for t, held in enumerate(tops):
                    for after in range(4):
                        if held and costs[4 * t + after] is not None:
                            way = held[0] + costs[4 * t + after], held[1], ranks[4 * t + after], t
                            if after not in best or way < best[after]:
                                best[after] = way
                least = min(w[0] for w in best.values())
                order = {t: n for n, t in enumerate(sorted(best, key=lambda t: best[t][1:3]))}
                tops = tuple((best[t][0] - least, order[t]) if t in best else None for t in range(4))
                backs.append({t: w[3] for t, w in best.items()})
                names.append((seg, before))
                before = last
            _, top, inserts = parser.end(tops)
            trailing, last_top = inserts, top
            found = []
            for back, (seg, first) in zip(reversed(backs), reversed(names), strict=True):
                found.append((conv, seg, back[top], top, first, trailing))
                top, trailing = back[top], 0
            yield from reversed(found)

    return _batched(choices(), ("conv_id", "seg", "begins", "ends", "before", "trailing"))


def _edits_of_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Edits of segments whose first and last tops are chosen; texts and kept roles are joined later."""
    parser = Parser()

    def edits() -> Iterator[tuple]:
        for _, stream in _streams(batches, (*_MARKED, "begins", "ends", "before", "trailing"), 2):
            rows = list(stream)
            conv, begins, ends, before, trailing = rows[0][0], *rows[0][7:]
            stack = Stack(parser, begins)
            for r in rows:
                stack.read(_row(r[4], r[5]))
            letters = stack.letters(ends)
            writer = _Writer(conv, before)
            for (_, _, pos, turn, initial, fault, n, *_), own, new in zip(rows, letters, turns(letters, [r[4] for r in rows], begins), strict=True):
                writer.row(pos, turn, initial, fault, n, own, new, None, fault == "truncated")
            writer.close(rows[-1][2] + 1, closing(ends, trailing))
            yield from writer.out

    return _batched(edits(), _NAMES)


def _fault_column(text: Column) -> Column:
    last = F.right(F.rtrim(text, F.lit(_WHITE)), F.lit(1))
    return F.when(last == "", "blank").when(~last.isin(*_ENDS), "truncated")


def _repair_large(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Edits of conversations that may be larger than a task."""
    by = ["conv_id", "turn", "role"]
    ordered = rows.repartitionByRange(*by, F.substring("text", 1, RANGED)).sortWithinPartitions(*_KEYS)
    ordered = materialize(ordered.withColumn("pos", F.monotonically_increasing_id()))
    marks = ordered.select(
        "conv_id", F.shiftright("pos", 33).alias("seg"), "pos", "turn", F.substring("role", 1, 1).alias("initial"), "n", _fault_column(F.col("text")).alias("own"),
        F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "role").alias("k2"),
    )
    firsts = marks.where("own is null or own <> 'blank'").groupBy("conv_id", "k1", "k2").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = F.when(F.col("own") == "blank", "blank").when(F.col("first").isNull(), "duplicate").otherwise(F.col("own"))
    marked = materialize(marks.join(firsts, "pos", "left").select(*[fault.alias(c) if c == "fault" else F.col(c) for c in _MARKED]))

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition("seg").sortWithinPartitions("seg", "pos")

    key = f"conv_id {kinds['conv_id']}, seg long"
    tables = map_batches(in_order(marked), _segment_tables, f"{key}, costs array<long>, ranks array<int>, last string")
    chosen = map_batches(tables.repartition("conv_id").sortWithinPartitions("conv_id", "seg"), _chosen, f"{key}, begins int, ends int, before string, trailing int")
    chosen = chosen.select(F.col("conv_id").alias("own_id"), F.col("seg").alias("own_seg"), "begins", "ends", "before", "trailing")
    known = marked.join(chosen, F.col("conv_id").eqNullSafe(F.col("own_id")) & (F.col("seg") == F.col("own_seg"))).drop("own_id", "own_seg")
    edits = map_batches(in_order(known), _edits_of_segments, f"conv_id {kinds['conv_id']}, " + _EDITS.format(turn=kinds["turn"]))
    said = ordered.select(F.col("pos").alias("place"), F.col("role").alias("own_role"), F.col("text").alias("own_text"), F.lit(True).alias("own"))
    takes = F.col("edit").isin(KEEP, "R")
    taken = edits.where(takes).join(said, "place").withColumn("role", F.coalesce("role", "own_role")).withColumn("text", F.col("own_text"))
    return taken.select(*_NAMES).unionByName(edits.where(~takes).select(*_NAMES))


def repair_conversations(conversations: DataFrame, *, large: int = LARGE) -> DataFrame:
    """One row per edit: ``conv_id, place, step, turn, fault, illegal, edit, times, role, text, cost``.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are not read. Rows of a conversation
    are taken by turn (nulls first), ties by role and text. ``edit`` is K, R (new role), D or I (inserted, with
    an empty text); ``place, step`` order the edits of a conversation; ``role, text`` are those of the repaired
    turn, null if it is deleted; ``fault`` is blank, duplicate or truncated, the first that holds; ``illegal``
    counts adjacent initials that do not follow each other; equal rows of one turn may share one deletion,
    ``times`` says how many; ``cost`` is that of the edit with its row's truncation. Of equally cheap repairs
    the one whose edits come first in ASCII is taken.

    Null roles and texts are one space. A null key is one conversation. Repeated rows are duplicates; a role
    that begins with none of s, u, a, or is empty, can only be rerolled or deleted. Texts of any length are
    kept whole. Conversations of over ``large`` bytes are cut into segments (a few smaller ones may be, too);
    the result is the same. An empty table gives no rows.
    """
    kinds = {f.name: f.dataType.simpleString() for f in conversations.schema}
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, n long"
    folded = map_batches(rows, _folded, schema).withColumn("key", F.xxhash64("conv_id"))
    sizes = folded.groupBy("key").agg(F.sum(F.octet_length("text") + F.octet_length("role") + F.lit(32)).alias("size"))
    above = materialize(sizes.where(F.col("size") > large).select("key"))
    small, parts = folded, None
    if not above.isEmpty():
        parts, small = split(folded, bitmap(above, "key"), "key")
    together = small.drop("key").repartition("conv_id").sortWithinPartitions(*_KEYS)
    edits = map_batches(together, _edits_of_small, f"conv_id {kinds['conv_id']}, " + _EDITS.format(turn=kinds["turn"]))
    return edits if parts is None else edits.unionByName(_repair_large(parts.drop("key"), kinds))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of ``conv_id:turn`` modulo 20: dropped, emptied, without ends, repeated, or the user's."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(named) % 20
    text = F.coalesce("text", space)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", space))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    return rows.drop("copy")


def repair_digests(edits: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per id in ``ids`` with the counts, cost, audit and digest of its edits.

    Edits of a conversation are read as a sorted stream, one at a time; only its audit, which is a value of
    the result, is held. An id without edits has zeros, an empty audit and the digest of an empty string.
    """
    kind = edits.schema["conv_id"].dataType.simpleString()
    columns = ("conv_id", "turn", "fault", "illegal", "edit", "times", "role", "text", "cost")
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def results() -> Iterator[tuple]:
            for (conv,), rows in _streams(batches, columns, 1):
                low = high = None
                distinct = illegal = cost = 0
                counts = {"blank": 0, "duplicate": 0, "truncated": 0, None: 0}
                audit, digest, started = [], hashlib.sha256(), False
                for _, turn, fault, wrong, edit, times, role, text, own in rows:
                    if turn is not None and turn != high:
                        low = turn if low is None else low
                        high, distinct = turn, distinct + 1
                    counts[fault] += times
                    illegal, cost = illegal + wrong, cost + own
                    audit.append(edit * times)
                    if edit != DELETE:
                        digest.update(f"{chr(10) * started}{role}:{text}".encode())
                        started = True
                gaps = 0 if low is None else high - low + 1 - distinct
                yield conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, "".join(audit), digest.hexdigest()

        return _batched(results(), names)

    stream = edits.select(*columns, "place", "step").repartition("conv_id").sortWithinPartitions("conv_id", "place", "step")
    schema = f"own_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    found = map_batches(stream.select(*columns), lambda b: ({"own_id" if k == "conv_id" else k: v for k, v in d.items()} for d in work(b)), schema)
    every = ids.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("own_id")), "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return every.select("conv_id", *[F.coalesce(c, F.lit(none.get(c, 0))).alias(c) for c in names[1:]])
