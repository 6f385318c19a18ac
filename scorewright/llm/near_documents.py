"""Documents whose sets of word shingles have a Jaccard similarity of at least 0.8, by a size-aware join.

Equal sets are one class. All sets are ordered alike, rare shingles before frequent ones. Two sets that link
share one of their first shingles (the prefix), and two of a prefix one longer. Small sets are looked up by
all pairs of the longer prefix; large sets scan the inverted lists of the single shingles of theirs. The size
that divides them is the one with the least cost, from the sizes and list lengths measured before. Small sets
that may link to large ones are entered in the lists too.

Every class of a list is compared with one pivot first, which settles large groups in linear work. Classes
that are then connected need no comparison; of the others in a list, pairs remain only where sizes, places in
the order and the distances to the pivot (Jaccard distance is a metric) allow a link. These are compared, first
by counts of their shingles in cells, which bound what two sets can share, then by the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.components import components
from scorewright.llm.filters import bitmap, marked
from scorewright.llm.shingles import mixed, set_id, shingle_sets
from scorewright.storage import discard, materialize, materialize_shuffled

#: A link: 100 * common shingles >= PERCENT * all shingles of both.
PERCENT = 80
#: Shingles that a task counts at once, the count there that makes one frequent, and the number of frequent
#: shingles that are ordered last. The bound limits what is sent to all tasks; rarer ones are merely ordered earlier.
COUNTED, OFTEN, FREQUENT = 4 << 20, 3, 1 << 18
#: Largest size that pairs are weighed for; cost of a compared pair in entries of a list; parts of a frequent list.
LARGEST_SMALL, PAIR_COST, PARTS = 64, 4.0, 16
#: Cells that shingles are counted in.
CELLS = 256
#: Classes that a task remembers as seen.
SEEN = 1 << 20


def least_common(n: int) -> int:
    """Shingles that a set of n shares at least with a set that it links to."""
    return -(-PERCENT * n // 100)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _measure(key: str):
    """Rows of three kinds: 0 documents, 1 frequent shingles of a task, 2 lengths of its lists."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ("kind", "own", key, "n", "set_id", "token", "count")
        held: list[np.ndarray] = []
        size = 0

        def counted() -> dict:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= OFTEN
            rare = counts[~often].astype(np.int64)
            m = int(often.sum())
            nothing = [None] * (m + 1)
            return dict(zip(names, ([1] * m + [2], nothing, nothing, nothing, nothing, [*_signed(tokens[often]).tolist(), int((rare * (rare - 1)).sum())], [*counts[often].tolist(), int(rare.sum())]), strict=True))

        for batch in batches:
            for part, texts in text_slices(batch):
                sets = shingle_sets(texts)
                n = len(texts)
                yield dict(zip(names, ([0] * n, part.column("own"), part.column(key), [len(s) for s in sets], [set_id(s) for s in sets], [None] * n, [None] * n), strict=True))
                held += sets
                size += sum(map(len, sets))
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    return work


def _prefix(light: np.ndarray, heavy: np.ndarray, length: int) -> np.ndarray:
    return np.concatenate([light[:length], heavy[: max(0, length - len(light))]])


def _entries(frequent: np.ndarray, small: int):
    """Entries of the lists: key, class, its size, the key's place in its order, its rare shingles; each class once a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: set[int] = set()
        for batch in batches:
            for _, texts in text_slices(batch):
                keys, owners, places, parts, rare = [], [], [], [], []
                for s in shingle_sets(texts):
                    n, own = len(s), set_id(s)
                    if n < 2 or own in seen:  # a set of one links to equal sets only
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(own)
                    at = np.minimum(np.searchsorted(frequent, s), max(0, len(frequent) - 1))
                    often = frequent[at] == s if len(frequent) else np.zeros(n, bool)
                    light, heavy = s[~often], s[often]
                    spare = n - least_common(n)
                    found = []
                    if n <= small and spare + 2 <= n:
                        longer = _prefix(light, heavy, spare + 2)
                        i, j = np.triu_indices(len(longer), 1)
                        pairs = mixed(longer[i] * np.uint64(0x9E3779B97F4A7C15) ^ mixed(longer[j]))
                        found.append((pairs, np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)))
                    if n > small or n * 100 // PERCENT > small:
                        single = _prefix(light, heavy, spare + 1)
                        hot = np.arange(len(single)) >= len(light)
                        part = np.where(hot, own % PARTS + 1, 0)
                        found.append((single, np.arange(len(single)), part))
                    for k, place, part in found:
                        keys.append(k)
                        owners.append(np.full(len(k), own, np.int64))
                        places.append(place + (n << 32))
                        parts.append(part)
                        rare.append(np.full(len(k), len(light), np.int32))
                if keys:
                    yield {"key": _signed(np.concatenate(keys)), "set_id": np.concatenate(owners), "place": np.concatenate(places), "part": np.concatenate(parts), "rare": np.concatenate(rare)}

    return work


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Of entries sorted by key and class, those of keys with several classes; parts of frequent keys pass whole."""
    held, passed = None, False  # the last entry, and whether it was given out
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "set_id", "place", "part", "rare")]
        if held is not None:
            columns = [np.concatenate([[x], y]) for x, y in zip(held, columns, strict=True)]
        key, own = columns[:2]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        key, own, place, part, rare = (c[fresh] for c in columns)
        again = key[1:] == key[:-1]
        several = part > 0
        several[1:] |= again
        several[:-1] |= again
        several[0] |= passed
        out = several.copy()
        out[0] &= not passed
        yield {"key": key[out], "set_id": own[out], "place": place[out], "rare": rare[out]}
        held, passed = (key[-1], own[-1], place[-1], part[-1], rare[-1]), bool(several[-1])


def _needed_sets(filter_bits: np.ndarray):
    """Sets of the marked texts, with the number of their shingles in each of ``CELLS`` cells."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            needed = batch.filter(pa.array(marked(filter_bits, batch.column("own").to_numpy())))
            for _, texts in text_slices(needed):
                sets = [s for s in shingle_sets(texts) if len(s) > 1]
                if sets:
                    cells = [np.bincount((s % CELLS).astype(np.int64), minlength=CELLS) for s in sets]
                    yield {"set_id": [set_id(s) for s in sets], "n": [len(s) for s in sets], "cells": cells, "shingles": [_signed(s) for s in sets]}

    return work


def _may_link(a: str, b: str) -> Column:
    """Whether two entries of a list can be the first common shingle of sets that link."""
    size = lambda x: F.shiftright(F.col(f"{x}.place"), 32)
    rest = lambda x: size(x) - F.col(f"{x}.place").bitwiseAND(0xFFFFFFFF)
    most = F.least(rest(a), rest(b))
    return (100 + PERCENT) * most >= PERCENT * (size(a) + size(b))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, low, high, linked`` for pairs of classes: bounds of their distance, equal where it was computed.
    The stored ``sets`` are deleted afterwards.

    Two sets share no more shingles than their cells do, which settles most pairs that do not link. The whole
    sets meet for the others only.
    """
    x = sets.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("cells").alias("x"))
    y = sets.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("cells").alias("y"))
    most = F.aggregate(F.zip_with("x", "y", lambda p, q: F.least(p, q).cast("long")), F.lit(0).cast("long"), lambda t, v: t + v)
    bounded = pairs.join(y, "b").join(x, "a").select("a", "b", most.alias("common"), (F.col("n_a") + F.col("n_b")).alias("total"))
    near = 100 * F.col("common") >= PERCENT * (F.col("total") - F.col("common"))
    distance = 1 - F.col("common") / (F.col("total") - F.col("common"))
    bounded = materialize_shuffled(bounded.withColumn("near", near).dropDuplicates(["a", "b"]))
    far = bounded.where("not near").select("a", "b", distance.alias("low"), F.lit(1.0).alias("high"), F.lit(False).alias("linked"))
    x, y = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    exact = bounded.where("near").select("a", "b", "total").join(y, "b").join(x, "a").withColumn("common", F.size(F.array_intersect("x", "y")))
    exact = exact.select("a", "b", distance.alias("low"), distance.alias("high"), near.alias("linked")).dropDuplicates(["a", "b"])
    compared = materialize_shuffled(exact.unionByName(far))
    discard(bounded, sets)
    return compared


def choose_boundary(sizes: dict[int, int], list_length: float) -> int:
    """The largest size of small sets with the least total cost, from the number of sets of each size."""
    best, cost, least = 0, 0.0, 0.0
    for n in range(2, LARGEST_SMALL + 1):
        spare = n - least_common(n)
        pairs = (spare + 2) * (spare + 1) / 2 if spare + 2 <= n else 0
        cost += sizes.get(n, 0) * (pairs - (spare + 1) * (1 + PAIR_COST * list_length))
        if cost <= least and sizes.get(n, 0):
            best, least = n, cost
    return best


def near_documents(documents: DataFrame, *, key: str = "doc_id", rows_of: bool = False) -> DataFrame:
    """``key, n_shingles, component_id`` of every row: its set's size and the smallest key linked to it.

    A text without words (null, empty or blank) has an empty set and links with nothing. A row without key
    takes part but is nobody's smallest; alone, its component is null. Rows with the same key are documents
    of their own. An empty table gives no rows; other columns are not read; texts of any length are read
    whole. Sets and shingles are told apart by 64-bit fingerprints. Texts are read three times, and only
    fingerprints are shuffled. Tables in the shared folder are deleted when they are used up.

    With ``rows_of`` there are two more columns: ``own``, the ``xxhash64`` of the row's key and text, and
    ``first``, that of the row with the smallest key of those linked (of several, the smallest ``own``).
    """
    kind = documents.schema[key].dataType.simpleString()
    texts = documents.select(key, "text", F.xxhash64(key, "text").alias("own"))
    measured = materialize(map_batches(texts, _measure(key), f"kind int, own long, `{key}` {kind}, n long, set_id long, token long, count long"))
    rows = measured.where("kind = 0").select("own", key, "n", "set_id")
    ranked = measured.where("kind = 1").groupBy("token").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "token").limit(FREQUENT)
    frequent = np.sort(ranked.toArrow().column("token").to_numpy().astype(np.int64).view(np.uint64))
    lists = measured.where("kind = 2").agg(F.sum("token"), F.sum("count"), F.count("*")).first()
    met = (lists[0] or 0) / max(1, lists[1] or 0) * max(1, lists[2])
    sizes = {r.n: r.sets for r in rows.where(F.col("n").between(2, LARGEST_SMALL)).groupBy("n").agg(F.count("*").alias("sets")).collect()}
    small = choose_boundary(sizes, met)

    entries = map_batches(texts, _entries(frequent, small), "key long, set_id long, place long, part int, rare int")
    dealt = entries.repartition("key", "part").sortWithinPartitions("key", "set_id")
    lists = materialize_shuffled(map_batches(dealt, _shared, "key long, set_id long, place long, rare int"))

    # A list's pivot is the class with the fewest rare shingles: of copies with changes of their own, the one that
    # all others resemble most. As this does not depend on the list, a group has about one pivot in all its lists.
    chosen = F.struct("rare", "set_id")
    pivots = lists.groupBy("key").agg(F.min_by(F.struct("set_id", "place"), chosen).alias("p")).select("key", F.col("p.set_id").alias("pivot"), F.col("p.place").alias("place"))
    met_pivot = lists.alias("e").join(pivots.alias("p"), "key").where((F.col("set_id") != F.col("pivot")) & _may_link("e", "p"))
    first = materialize_shuffled(met_pivot.select(F.greatest("set_id", "pivot").alias("a"), F.least("set_id", "pivot").alias("b")).distinct())

    def whole_sets(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
        holders = rows.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("own").alias("own"))  # one text of each
        return materialize(map_batches(texts, _needed_sets(bitmap(holders, "own")), "set_id long, n long, cells array<int>, shingles array<long>"))

    compared = _compared(first, whole_sets(first))
    discard(first)
    links = compared.where("linked").select("a", "b")
    groups = components(links)

    # What is left of the lists: classes of several components.
    labelled = lists.join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    open_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    far = compared.select("a", "b", "low", "high")
    left = (
        labelled.join(open_keys, "key", "left_semi").join(pivots.select("key", "pivot"), "key")
        .withColumn("a", F.greatest("set_id", "pivot")).withColumn("b", F.least("set_id", "pivot")).join(far, ["a", "b"], "left")
        .select("key", "set_id", "place", "component", *[F.when(F.col("set_id") == F.col("pivot"), 0.0).otherwise(F.coalesce(c, F.lit(limit))).alias(c) for c, limit in (("low", 0.0), ("high", 1.0))])
    )
    left = materialize_shuffled(left)
    discard(lists)
    apart = F.greatest(F.col("x.low") - F.col("y.high"), F.col("y.low") - F.col("x.high")) <= 1 - PERCENT / 100 + 1e-9
    second = (
        left.alias("x").join(left.alias("y"), F.expr("x.key = y.key and x.set_id > y.set_id and x.component <> y.component"))
        .where(_may_link("x", "y") & apart).select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b")).distinct()
    )
    second = materialize_shuffled(second.join(compared.select("a", "b"), ["a", "b"], "left_anti"))
    discard(left)
    if not second.isEmpty():
        more = _compared(second, whole_sets(second)).where("linked").select("a", "b")
        groups = components(links.unionByName(more))
    discard(second)

    found = rows.join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").select("own", key, "n", F.when(F.col("n") > 0, F.coalesce("component", "set_id")).alias("component"))
    first = F.min(F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("key"), "own")))
    smallest = found.where("component is not null").groupBy("component").agg(first.alias("first"))
    more = ["own", F.coalesce("first.own", "own").alias("first")] if rows_of else []
    return found.join(smallest, "component", "left").select(key, F.col("n").alias("n_shingles"), F.coalesce("first.key", key).alias("component_id"), *more)
