"""Exact quantiles of many columns without sorting them, and modes of categories.

``percentile`` keeps every distinct value of a column in one buffer, and a
sort shuffles every value. Here a sketch brackets each quantile first; then
only the values inside the brackets are kept apart, while the values between
brackets are merely counted. The rank of every bracketed value is exact, so
the quantiles are, too. If a bracket should miss its quantile, the work is
repeated with a wider one, and at last with one around everything.

Sketches are mergeable: tasks sketch what they read, groups of tasks merge
their sketches, and a column's groups merge to one. What a bracket holds
depends on the sketch's size only, not on how values lie in the files.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import known_text, sql_number, sql_text
from ..storage import small_table
from .running import running_totals

# Size of a sketch. Ranks it tells are off by more than 0.07 % of the rows once in a hundred times.
_SKETCH = 8192
# Half-widths of the brackets that are tried in turn, as shares of the rows.
_MARGINS = (0.001, 0.008)
# Sketches of one column are merged by this many tasks first, then by one.
_SKETCH_GROUPS = 64

Bracket = tuple[float, float]


@dataclass(frozen=True)
class ColumnQuantiles:
    """Of the sample: rows, rows with a known number, mean, and the evenly spaced quantiles.

    ``others`` and ``others_mean`` describe the rows outside the sample.
    ``edges`` is empty without a known number.
    """

    rows: int
    known: int
    mean: float | None
    others: int
    others_mean: float | None
    edges: list[float]


def long_values(df: DataFrame, columns: Sequence[str], data_type: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """One row per input row and column: ``feature`` and ``value``, a double or else a string; NaN becomes null."""
    types = dict(df.dtypes)
    number = "nanvl(cast(`{}` as double), cast(null as double))"
    as_type = {c: number.format(c) if data_type == "double" else known_text(c, types[c]) for c in columns}
    cells = ", ".join(f"{sql_text(c)}, {as_type[c]}" for c in columns)
    return df.select(*keep, F.expr(f"stack({len(columns)}, {cells})").alias("feature", "value"))


def quantile_steps(parts: int) -> list[float]:
    return [k * (1.0 / parts) for k in range(parts)] + [1.0]


def column_quantiles(
    df: DataFrame, columns: Sequence[str], parts: int, sample: str = "true", **options
) -> dict[str, ColumnQuantiles]:
    """Per column the ``parts + 1`` quantiles of the rows where ``sample`` holds.

    Linear interpolation between the two nearest ranks; missing values are
    left out. The driver gets a few numbers per column.
    """
    df = df.select(*columns, F.expr(sample).alias("_sample"))
    steps = quantile_steps(parts)
    found = _summaries(df, columns, steps[1:-1])
    ranks = {c: _ranks(steps[1:-1], s["known"]) for c, s in found.items() if s["known"]}
    in_sample = df.filter("_sample")
    values: dict[str, dict[int, float]] = {c: {} for c in ranks}
    for attempt in range(len(_MARGINS) + 1):
        missed = {c: ranks[c] for c in ranks if len(values[c]) < len(ranks[c])}
        if not missed:
            break
        values |= _values_at(in_sample, missed, {c: found[c]["brackets"][attempt] for c in missed}, **options)
    result = {}
    for c, s in found.items():
        edges = []
        if s["known"]:
            inner = [_interpolate(q * (s["known"] - 1), values[c]) for q in steps[1:-1]]
            edges = [s["low"], *inner, s["high"]]
        result[c] = ColumnQuantiles(
            s["rows"], s["known"], s["total"] / s["known"] if s["known"] else None,
            s["others"], s["others_total"] / s["others_known"] if s["others_known"] else None, edges,
        )
    return result


def _summaries(df: DataFrame, columns: Sequence[str], steps: Sequence[float]) -> dict[str, dict]:
    """One pass: counts, sums, extremes, and brackets around each step, one list for each margin and everything."""
    bounds = [b for m in _MARGINS for q in steps for b in (max(0.0, q - m), min(1.0, q + m))]
    marks = ", ".join(sql_number(q) for q in bounds)
    grouped = df.select("*", F.expr(f"pmod(spark_partition_id(), {_SKETCH_GROUPS})").alias("_group"))
    long = long_values(grouped, columns, keep=["_sample", "_group"])
    sums = {
        "rows": "count_if(_sample)", "others": "count_if(not _sample)",
        "known": "count(value) filter (where _sample)", "others_known": "count(value) filter (where not _sample)",
        "total": "coalesce(sum(value) filter (where _sample), 0D)",
        "others_total": "coalesce(sum(value) filter (where not _sample), 0D)",
    }
    groups = long.groupBy("feature", "_group").agg(
        *[F.expr(e).alias(name) for name, e in sums.items()],
        F.expr("min(value) filter (where _sample)").alias("low"),
        F.expr("max(value) filter (where _sample)").alias("high"),
        F.expr(f"kll_sketch_agg_double(value, {_SKETCH}) filter (where _sample)").alias("sketch"),
    )
    merged = groups.groupBy("feature").agg(
        *[F.sum(name).alias(name) for name in sums], F.min("low").alias("low"), F.max("high").alias("high"),
        F.expr(f"kll_merge_agg_double(sketch, {_SKETCH}) filter (where known > 0)").alias("sketch"),
    )
    quantiles = f"if(known > 0, kll_sketch_get_quantile_double(sketch, array({marks})), null)" if bounds else "array()"
    result = {}
    for row in merged.withColumn("marks", F.expr(quantiles)).drop("sketch").collect():  # a row per column
        summary = row.asDict()
        if row.known:
            pairs = list(zip(row.marks[::2], row.marks[1::2]))
            n = len(steps)
            summary["brackets"] = [_merge(pairs[k * n : (k + 1) * n]) for k in range(len(_MARGINS))]
            summary["brackets"].append([(-math.inf, math.inf)])
        result[row.feature] = summary
    none = dict.fromkeys(sums, 0)
    return {c: result.get(c, none) for c in columns}


def _merge(brackets: list[Bracket]) -> list[Bracket]:
    """Join overlapping brackets."""
    merged: list[Bracket] = []
    for low, high in sorted(brackets):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _ranks(steps: Sequence[float], known: int) -> list[int]:
    positions = [q * (known - 1) for q in steps]
    return sorted({r for pos in positions for r in (math.floor(pos), math.ceil(pos))})


def _interpolate(position: float, values: dict[int, float]) -> float:
    low, high = values[math.floor(position)], values[math.ceil(position)]
    t = position - math.floor(position)
    return high - (high - low) * (1 - t) if t >= 0.5 else low + (high - low) * t


def _values_at(
    df: DataFrame, ranks: dict[str, list[int]], brackets: dict[str, list[Bracket]], **options
) -> dict[str, dict[int, float]]:
    """The values at the given zero-based ranks; ranks outside the brackets are left out."""
    if not ranks:
        return {}
    spark = df.sparkSession
    # Every column gets as many brackets as the one with most; the last repeats.
    most = max(len(brackets[c]) for c in ranks)
    padded = {c: brackets[c] + brackets[c][-1:] * (most - len(brackets[c])) for c in ranks}
    bounds = small_table(
        spark, feature=list(padded),
        low=[[b[0] for b in found] for found in padded.values()],
        high=[[b[1] for b in found] for found in padded.values()],
    )
    inside = " or ".join(f"value between low[{k}] and high[{k}]" for k in range(most))
    # A value between brackets stands for its whole gap, which sorts directly
    # before the next bracket.
    gap = " ".join(f"when value < low[{k}] then low[{k}]" for k in range(most))
    long = long_values(df, list(ranks)).filter("value is not null")
    cells = (
        long.join(F.broadcast(bounds), "feature")  # a row per listed column
        .select("feature", "value", "low", F.expr(inside).alias("inside"))
        .select(
            "feature", "inside",
            F.expr(f"case when inside then value {gap} else double('Infinity') end").alias("value"),
        )
    )
    counts = (
        cells.groupBy("feature", "value", "inside").agg(F.expr("count(*)").alias("n"))
        .select("feature", F.struct("value", "inside").alias("cell"), "n")
    )
    ranked = running_totals(counts, ["feature"], "cell", ["n"], **options)
    wanted = small_table(
        spark,
        feature=[c for c, found in ranks.items() for _ in found],
        rank=[r for found in ranks.values() for r in found],
    )
    covers = F.expr("n_upto - n <= rank and rank < n_upto and cell.inside")
    at = ranked.join(F.broadcast(wanted), "feature").filter(covers)  # a few ranks per listed column
    values: dict[str, dict[int, float]] = {c: {} for c in ranks}
    for row in at.select("feature", "rank", "cell.value").collect():
        values[row.feature][row.rank] = row.value
    return values


def text_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and known text."""
    long = long_values(df, columns, "string").filter("value is not null")
    return long.groupBy("feature", F.col("value").alias("text")).agg(F.expr("count(*)").alias("n"))


def modes(counts: DataFrame) -> DataFrame:
    """Per column the most frequent text of :func:`text_counts`.

    Ties go to the smallest, by number where the text is one.
    """
    return counts.groupBy("feature").agg(
        F.expr("min_by(text, struct(-n, try_cast(text as double), text))").alias("mode")
    )
