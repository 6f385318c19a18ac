"""Running totals over a table of any size.

A window with few partitions is a window with few tasks. So the table is
written out range-partitioned on its order, in ranges of a bounded number of
rows; each range is summed on its own, opened with the totals of the ranges
before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..storage import discard, materialize, materialize_checked

_RANGE, _OPENING = "_range", "_opening"


def running_totals(
    table: DataFrame,
    by: Sequence[str],
    order: str,
    measures: Sequence[str],
    *,
    descending: bool = False,
    reject: tuple[str, str] = ("false", ""),
    rows_per_task: int = config.ROWS_PER_TASK,
) -> DataFrame:
    """Add ``<measure>_upto`` columns: totals of all rows at or before this one.

    ``table`` must hold one row per (``by``, ``order``); aggregate it first, so
    that ties and hot values are single rows here and ranges come out even. It
    is computed once. ``reject`` is an SQL condition that no row may meet, and
    the error if one does.
    """
    by = list(by)
    order_by = F.desc(order) if descending else F.asc(order)
    counted, seen = materialize_checked(table, rejected=f"count_if({reject[0]})")
    if seen["rejected"]:
        raise ValueError(reject[1])
    ranges = max(table.sparkSession.sparkContext.defaultParallelism, -(-seen["rows"] // rows_per_task))
    # The range number is written with the rows: it must not change between the
    # reads below, even when a lost executor makes Spark redo a task.
    ranged = materialize(
        counted.repartitionByRange(ranges, *by, order_by).withColumn(_RANGE, F.spark_partition_id())
    )
    discard(counted)

    # One row per range and group: ranges are contiguous, so there are at most
    # (ranges + groups) of them, and at most (ranges) in one group.
    before = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    openings = (
        ranged.groupBy(*by, _RANGE)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            *by, _RANGE,
            *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(m) for m in measures],
            F.lit(True).alias(_OPENING),
        )
    )
    together = ranged.withColumn(_OPENING, F.lit(False)).unionByName(openings, allowMissingColumns=True)
    inside = _upto([*by, _RANGE], F.desc(_OPENING), order_by)
    summed = together.select("*", *[F.sum(m).over(inside).alias(f"{m}_upto") for m in measures])
    return summed.filter(~F.col(_OPENING)).drop(_RANGE, _OPENING)


def _upto(by: list[str], *order):
    return (
        Window.partitionBy(*by).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
