"""Exact top-k search by inner product of integer vectors, by distributed histogram selection.

Blocks of queries meet blocks of candidates and score everything. Each round a block reports, per query, a
histogram of the scores in the query's current range, from the top down to where its own counts reach what
is wanted: the k-th score of all blocks cannot lie lower. The summed histogram narrows the range, until it
holds one value. A last round takes the higher scores and, of equal ones, as many of the smallest ids as are
wanted. Blocks are bounded, so are their reports; nothing but bounds reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches
from scorewright.llm.vectors import finite, matrix, one_by_one, per_group
from scorewright.storage import materialize

#: Vectors of a candidate block and of a query block, and bins of a histogram.
CANDIDATES, QUERIES, BINS = 8192, 1024, 512
SCALE = 256


def _packed(table: pa.Table) -> dict:
    """One block: ids and integer vectors in the order of the ids."""
    table = table.sort_by("vec_id")
    scaled = np.floor(matrix(table, "embedding") * SCALE)
    if np.abs(scaled).max(initial=0) >= 2.0**62:
        raise OverflowError("a component times 256 does not fit a long")
    first = table.slice(0, 1)
    return {"dim": first.column("dim").to_pylist(), "block": first.column("block").to_pylist(), "ids": [table.column("vec_id").to_pylist()], "copies": [table.column("copies").to_pylist()], "first": [table.column("first").to_pylist()], "data": [scaled.astype("<i8").tobytes()], "norm": [float(np.sqrt((scaled**2).sum(axis=1)).max(initial=0))]}


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids, and exact scores of all of them."""
    queries, candidates = (np.frombuffer(row[c], "<i8").reshape(-1, row["dim"]) for c in ("query_data", "data"))
    if float(row["query_norm"]) * float(row["norm"]) < 2.0**52:
        found = np.rint(queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    else:
        found = (queries.astype(object) @ candidates.T.astype(object)).astype(np.int64)  # fails beyond a long
    query_ids, ids = np.array(row["query_ids"]), np.array(row["ids"])
    return query_ids, ids, found


def _others(row: dict, ids: np.ndarray, query: int) -> np.ndarray:
    """How many rows each candidate stands for, without the query's own row."""
    return np.array(row["copies"]) - (np.array(row["first"]) & (ids == query))


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for row in one_by_one(batches):
        query_ids, ids, found = _scores(row)
        out: tuple[list, list, list] = ([], [], [])
        for q, scores, low, high, wanted in zip(query_ids.tolist(), found, row["low"], row["high"], row["wanted"], strict=True):
            copies = _others(row, ids, q)
            some = (copies > 0) & (scores >= low) & (scores < high)
            if some.any():
                width = -(-(high - low) // BINS)
                counts = np.bincount((scores[some] - low) // width, weights=copies[some], minlength=1).astype(np.int64)[::-1]
                stop = int(np.searchsorted(counts.cumsum(), wanted)) + 1
                top = len(counts) - 1
                kept = np.flatnonzero(counts[:stop])
                out[0].extend([q] * len(kept))
                out[1].extend((top - kept).tolist())
                out[2].extend(counts[kept].tolist())
        if out[0]:
            yield dict(zip(("query_id", "bin", "n"), out, strict=True))


def _winners(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for row in one_by_one(batches):
        query_ids, ids, found = _scores(row)
        out: tuple[list, list, list, list] = ([], [], [], [])
        for q, scores, low, wanted in zip(query_ids.tolist(), found, row["low"], row["wanted"], strict=True):
            copies = _others(row, ids, q)
            above = np.flatnonzero((copies > 0) & (scores > low))
            equal = np.flatnonzero((copies > 0) & (scores == low))  # ids ascend
            equal = equal[: int(np.searchsorted(copies[equal].cumsum(), wanted)) + 1]
            kept = np.concatenate([above, equal])
            out[0].extend([q] * len(kept))
            out[1].extend(ids[kept].tolist())
            out[2].extend(scores[kept].tolist())
            out[3].extend(copies[kept].tolist())
        if out[0]:
            yield dict(zip(("query_id", "vec_id", "score", "copies"), out, strict=True))


def top_k(embeddings: DataFrame, is_query: str, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all rows for each row that ``is_query`` (SQL) names.

    Vectors that are null or empty or hold null or non-finite numbers take no part, nor do rows without an
    id; vectors of different lengths do not meet; other columns are not read. Every row is a candidate: rows
    that repeat an id and its vector are one row with their number until the end. An id that is repeated with
    several vectors asks with the smallest, and only that one row is no candidate of its own. Equal scores go
    to the smaller id; with fewer candidates all are returned; an empty table gives no rows. Scores beyond a
    long raise an error.
    """
    rows = embeddings.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & finite("embedding"))
    rows = materialize(rows.groupBy("vec_id", "embedding").agg(F.count("*").alias("copies")))
    smallest = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("first", F.lit(True))
    rows = rows.join(smallest, ["vec_id", "embedding"], "left").select(
        F.col("vec_id").cast("long"), "embedding", "copies", F.coalesce("first", F.lit(False)).alias("first"), F.size("embedding").alias("dim")
    )
    rows = materialize(rows)

    def blocks(df: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
        sizes = df.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
        numbered = df.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), "blocks").cast("int"))
        return materialize(per_group(numbered.drop("blocks"), ["dim", "block"], _packed, "dim int, block int, ids array<long>, copies array<long>, first array<boolean>, data binary, norm double")), sizes

    candidates, sizes = blocks(rows, CANDIDATES)
    queries, _ = blocks(rows.where("first").where(is_query), QUERIES)
    queries = queries.select("dim", F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("data").alias("query_data"), F.col("norm").alias("query_norm"))
    reach = candidates.groupBy("dim").agg(F.max("norm").alias("reach"))
    bound = F.ceil(F.col("query_norm") * F.col("reach") * (1 + 1e-9)).cast("long") + 1
    state = materialize(
        queries.join(reach, "dim").withColumn("bound", bound)
        .select("query_block", F.explode("query_ids").alias("query_id"), "dim", (-F.col("bound")).alias("low"), (F.col("bound") + 1).alias("high"), F.lit(k).cast("long").alias("wanted"), F.lit(False).alias("done"))
    )

    def meet(now: DataFrame) -> DataFrame:
        ranges = now.groupBy("dim", "query_block").agg(F.array_sort(F.collect_list(F.struct("query_id", "low", "high", "wanted"))).alias("r"))
        ranges = ranges.select("dim", "query_block", *[F.col(f"r.{c}").alias(c) for c in ("low", "high", "wanted")])
        asked = queries.join(ranges, ["dim", "query_block"]).join(sizes, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return asked.join(candidates, ["dim", "block"])

    while True:
        widest = state.agg(F.max(F.when(~F.col("done"), F.col("high") - F.col("low")))).first()[0]
        if widest is None or widest <= 1:
            break
        counts = map_batches(meet(state), _histograms, "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        placed = counts.withColumn("reached", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0))).join(state, "query_id")
        cell = (
            placed.where("reached >= wanted").groupBy("query_id")
            .agg(F.max_by(F.struct("bin", F.col("reached").alias("reached"), "n"), "bin").alias("c")).select("query_id", "c.*")
        )
        width = F.ceil((F.col("high") - F.col("low")) / F.lit(float(BINS))).cast("long")
        state = materialize(
            state.join(cell, "query_id", "left").withColumn("width", width)
            .withColumn("new_low", F.col("low") + F.col("bin") * F.col("width"))
            .select(
                "query_block", "query_id", "dim",
                F.coalesce("new_low", "low").alias("low"),
                F.coalesce(F.least("high", F.col("new_low") + F.col("width")), "high").alias("high"),
                F.coalesce(F.col("wanted") - (F.col("reached") - F.col("n")), "wanted").alias("wanted"),
                F.col("bin").isNull().alias("done"),  # fewer candidates than wanted: all of them
            )
        )
    found = map_batches(meet(state), _winners, "query_id long, vec_id long, score long, copies long")
    found = found.withColumn("copy", F.explode(F.expr(f"sequence(1L, least(copies, {k}L))")))  # no more can be among the k best
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


