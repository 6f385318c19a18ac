"""Report tables over scored rows: summary, risk bands, calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import calibration_bin, calibration_label, risk_band


def _rates(label: str, p: str) -> list:
    return [
        F.expr("count(*)").alias("clients"),
        F.expr(f"round(avg(`{label}`), 6)").alias("observed_default_rate"),
        F.expr(f"round(avg(`{p}`), 6)").alias("average_probability"),
    ]


def scored_summary(scored: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    return scored.agg(
        F.expr("count(*)").alias("scored_rows"),
        F.expr(f"sum(cast(`{label}` as bigint))").alias("observed_defaults"),
        F.expr(f"round(avg(`{label}`), 6)").alias("default_rate"),
        F.expr(f"round(avg(`{p}`), 6)").alias("average_probability"),
    )


def risk_bands(scored: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Always three rows, in band order; an empty band has zeros.

    One global aggregation with three filtered sets, so nothing is shuffled by
    band and no band is missing.
    """
    banded = scored.select(F.col(label).alias("y"), F.col(p).alias("p"), risk_band(p).alias("band"))
    rows = ", ".join(
        f"struct('{band}' as band, count(*) filter (where band = '{band}') as clients,"
        f" coalesce(round(avg(y) filter (where band = '{band}'), 6), 0D) as observed_default_rate,"
        f" coalesce(round(avg(p) filter (where band = '{band}'), 6), 0D) as average_probability)"
        for band in config.BANDS
    )
    return banded.agg(F.expr(f"array({rows})").alias("rows")).select(F.inline("rows"))


def calibration_bins(scored: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Non-empty bins in order, with their interval text."""
    return (
        scored.groupBy(calibration_bin(p).alias("bin_index"))
        .agg(*_rates(label, p))
        .filter("bin_index is not null")
        .coalesce(1).sortWithinPartitions("bin_index")  # at most ten rows
        .withColumn("bin", calibration_label("bin_index"))
    )


def band_cells(scored: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Rows, positives and summed scores per band and calibration bin: all that the report tables need."""
    return scored.groupBy(risk_band(p).alias("band"), calibration_bin(p).alias("bin_index")).agg(
        F.expr("count(*)").alias("n"), F.expr(f"sum(cast(`{label}` as bigint))").alias("pos"), F.expr(f"sum(`{p}`)").alias("total")
    )


def report_tables(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summary, risk bands and calibration bins from the few rows of :func:`band_cells`."""
    rates = [
        F.sum("n").alias("clients"),
        F.expr("round(sum(pos) / sum(n), 6)").alias("observed_default_rate"),
        F.expr("round(sum(total) / sum(n), 6)").alias("average_probability"),
    ]
    summary = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("scored_rows"), F.sum("pos").alias("observed_defaults"),
        F.expr("round(sum(pos) / sum(n), 6)").alias("default_rate"), F.expr("round(sum(total) / sum(n), 6)").alias("average_probability"),
    )
    names = cells.sparkSession.createDataFrame([(b,) for b in config.BANDS], "band string")
    banded = names.join(cells.groupBy("band").agg(*rates), "band", "left").na.fill(0)
    binned = cells.filter("bin_index is not null").groupBy("bin_index").agg(*rates)
    return summary, banded, binned.withColumn("bin", calibration_label("bin_index"))
