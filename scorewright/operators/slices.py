"""Performance per governance slice, all slice columns in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import slice_value
from .metrics import AVERAGE_PRECISION, ranked_scores, score_table


def present(columns: Sequence[str], *frames: DataFrame) -> list[str]:
    """The listed columns that every frame has, in the listed order."""
    return [c for c in columns if all(c in frame.columns for frame in frames)]


def slice_performance(
    scored: DataFrame, columns: Sequence[str], label: str = "label", p: str = "p", **options
) -> DataFrame:
    """Rows, observed and predicted rate, average precision per distinct value.

    Average precision is null for a slice with one class. Columns that the
    table lacks are left out. Values order as text.
    """
    columns = present(columns, scored)
    if not columns:
        return scored.sparkSession.createDataFrame(
            [], "slice_column string, value string, rows bigint,"
                " observed_default_rate double, predicted_default_rate double, pr_auc double"
        )
    by = ["slice_column", "value"]
    types = dict(scored.dtypes)
    long = scored.select(
        F.col(label).alias("label"), F.col(p).alias("p"),
        *[slice_value(c, types[c]).alias(c) for c in columns],
    ).unpivot(["label", "p"], columns, *by)
    ranked = ranked_scores(score_table(long, by), by, **options)
    return ranked.groupBy(*by).agg(
        F.sum("n").alias("rows"),
        F.expr("round(sum(pos) / sum(n), 6)").alias("observed_default_rate"),
        F.expr("round(sum(p * n) / sum(n), 6)").alias("predicted_default_rate"),
        F.expr(
            f"case when sum(pos) between 1 and sum(n) - 1 then round({AVERAGE_PRECISION}, 6) end"
        ).alias("pr_auc"),
    ).orderBy(*by)
