"""Append-only tables of registered models and logged runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import utc_stamp
from .digests import artifact_digest

NUMERIC_METRICS = ("roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score")


def registry_entry(metrics: DataFrame, selected: str, artifact: str) -> DataFrame:
    """One row describing the selected model and its artifact."""
    digest = artifact_digest(metrics.sparkSession, artifact).first().sha256
    return metrics.filter(F.col("model") == selected).select(
        utc_stamp().alias("version"),
        F.current_timestamp().alias("created_at"),
        F.lit("candidate").alias("stage"),
        "model",
        F.lit(config.SELECTION_METRIC).alias("selection_metric"),
        F.struct(*[c for c in metrics.columns if c != "model"]).alias("metrics"),
        F.lit(digest).alias("artifact_sha256"),
    )


def run_log(metrics: DataFrame, selected: str) -> DataFrame:
    """Parameters and numeric metrics of the selected model as (run, kind, key, value) rows."""
    chosen = metrics.filter(F.col("model") == selected)
    numbers = [c for c in NUMERIC_METRICS if c in metrics.columns]
    run = F.concat(F.lit("risk-"), F.col("model"))

    def row(kind: str, key: str, value):
        return F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), value.cast("string").alias("value"))

    rows = [
        row("param", "selected_model", F.col("model")),
        row("param", "selection_metric", F.lit(config.SELECTION_METRIC)),
        *[row("metric", c, F.col(c)) for c in numbers],
    ]
    return chosen.select(run.alias("run"), F.inline(F.array(*rows)))


def append(df: DataFrame, path: str) -> None:
    """Appending never rewrites earlier entries."""
    df.write.mode("append").parquet(path)
