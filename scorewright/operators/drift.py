"""Population stability of features and predictions, all columns in one job."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import all_close, drift_status, sql_number
from ..storage import small_table
from .quantiles import column_quantiles, long_values
from .slices import present


def tag_samples(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both samples in one table; ``is_reference`` tells them apart."""
    return reference.select(*columns, F.lit(True).alias("is_reference")).union(
        current.select(*columns, F.lit(False).alias("is_reference"))
    )


def stability_index(
    df: DataFrame, columns: Sequence[str], is_reference: str = "is_reference",
    bins: int = config.PSI_BINS, **options,
) -> DataFrame:
    """``feature``, ``psi``, ``reference_mean``, ``current_mean``, ``status`` per column.

    The SQL condition ``is_reference`` tells the samples apart. The bins are
    the reference sample's quantile ranges. A constant reference gives 0 if
    the current sample is all close to it, else 1. Missing reference values
    leave no bins and give 1.

    ``df`` is read three times: to bracket the quantiles, to find them, and to
    count the bins. No value of the table is shuffled but those in brackets.
    """
    found = column_quantiles(df, columns, bins, is_reference, **options)
    sizes = next(iter(found.values()))
    if not sizes.rows or not sizes.others:
        raise ValueError(f"drift needs two samples with rows; reference has {sizes.rows}, current {sizes.others}")
    # Inner edges of each column's bins, left-closed and open at both ends.
    # Repeated edges count once; NaN fills up, as no value is above it.
    edges = {c: sorted(set(q.edges)) for c, q in found.items()}
    kind = {
        c: "missing" if q.known < q.rows else "constant" if len(edges[c]) == 1 else "binned"
        for c, q in found.items()
    }
    inner = {c: (e[1:-1] + [math.nan] * bins)[: bins - 1] for c, e in edges.items()}
    held = small_table(
        df.sparkSession,
        feature=list(found), kind=list(kind.values()), inner=list(inner.values()),
        lowest=[e[0] if e else None for e in edges.values()],
        total_ref=[q.rows for q in found.values()], total_cur=[q.others for q in found.values()],
        ref_mean=[q.mean for q in found.values()], cur_mean=[q.others_mean for q in found.values()],
    )
    passed = " + ".join(f"int(value >= inner[{k}])" for k in range(bins - 1)) or "0"
    flagged = df.select(*columns, F.expr(is_reference).alias("_ref"))
    per_bin = (
        long_values(flagged, columns, keep=["_ref"])
        .join(F.broadcast(held.select("feature", "inner", "lowest")), "feature")  # a row per listed column
        .groupBy("feature", F.expr(f"if(value is null, null, {passed})").alias("bin"))
        .agg(
            F.expr("count_if(_ref)").alias("n_ref"),
            F.expr("count_if(not _ref)").alias("n_cur"),
            F.expr(f"bool_and(_ref or coalesce({all_close('lowest', 'value')}, false))").alias("close"),
        )
        .join(F.broadcast(held.drop("inner", "lowest")), "feature")
    )
    ref, cur, eps = "(n_ref / total_ref)", "(n_cur / total_cur)", sql_number(config.PSI_EPSILON)
    term = f"({cur} - {ref}) * ln(({cur} + {eps}) / ({ref} + {eps}))"
    psi = (
        "case first(kind) when 'missing' then 1D when 'constant' then if(bool_and(close), 0D, 1D)"
        f" else round(sum({term}) filter (where bin is not null), 6) end"
    )
    return per_bin.groupBy("feature").agg(
        F.expr(psi).alias("psi"),
        F.expr("round(first(ref_mean), 6)").alias("reference_mean"),
        F.expr("round(first(cur_mean), 6)").alias("current_mean"),
    ).withColumn("status", drift_status("psi"))


def feature_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = config.PSI_BINS, **options
) -> DataFrame:
    """``feature``, ``psi``, ``status`` for the listed columns both tables have."""
    columns = present(columns, reference, current)
    if not columns:
        return reference.sparkSession.createDataFrame([], "feature string, psi double, status string")
    both = tag_samples(reference, current, columns)
    return stability_index(both, columns, bins=bins, **options).select("feature", "psi", "status")


def prediction_drift(
    reference: DataFrame, current: DataFrame, p: str = "p", bins: int = config.PSI_BINS, **options
) -> DataFrame:
    """One row: PSI of the scores, both means, status."""
    both = tag_samples(reference, current, [p])
    return stability_index(both, [p], bins=bins, **options).drop("feature")
