"""Report document: summary, models, bands and calibration of a scored table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators.bands import band_cells, report_tables
from ..operators.metrics import select_model
from ..operators.schema import require_columns
from ..sources.tables import read_json, read_scored, write_json
from ..storage import pin

DISCLAIMER = "Scores come from research data. They must not decide about real people's credit."

METRICS_SCHEMA = (
    "selection_metric string, selected_model string, models array<struct<name: string, roc_auc: double,"
    " pr_auc: double, precision: double, recall: double, f1: double, brier_score: double,"
    " confusion_matrix: array<array<bigint>>>>"
)


def document(single: dict[str, DataFrame], lists: dict[str, DataFrame]) -> DataFrame:
    """One row: a struct per ``single`` table, an array of structs per ``lists`` table.

    A list table's first column gives the order and is left out. The tables
    are report tables of a few rows; they are stacked and folded, not joined.
    """
    frames = [df.select(F.struct(*df.columns).alias(name)) for name, df in (single | lists).items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    folded = [F.first(name, ignorenulls=True).alias(name) for name in single]
    for name, df in lists.items():
        folded.append(_without_first(F.array_sort(F.collect_list(name)), df.columns).alias(name))
    return stacked.agg(*folded)


def _without_first(items: Column, fields: list[str]) -> Column:
    return F.transform(items, lambda s: s.dropFields(fields[0]))


def metrics_document(metrics: DataFrame, order: list[str], **more: DataFrame) -> DataFrame:
    """Selection and metrics of every model; ``more`` adds one-row tables."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    models = metrics.select(
        place.alias("place"), F.col("model").alias("name"), *[c for c in metrics.columns if c != "model"]
    )
    chosen = select_model(metrics, order)
    return document({"selection": chosen, **more}, {"models": models}).select(
        "selection.selection_metric", "selection.selected_model", "models", *more
    )


_DRIFT_FIELDS, _SLICE_FIELDS = ["psi", "status"], ["rows", "observed_default_rate", "predicted_default_rate", "pr_auc"]
MONITORING_SCHEMA = (
    "prediction_drift struct<psi: double, reference_mean: double, current_mean: double, status: string>,"
    " feature_drift map<string, struct<psi: double, status: string>>,"
    " governance_slices map<string, map<string, struct<rows: bigint, observed_default_rate: double,"
    " predicted_default_rate: double, pr_auc: double>>>, thresholds struct<watch_psi: double, alert_psi: double>"
)


def monitoring_document(prediction: DataFrame, features: DataFrame, slices: DataFrame) -> DataFrame:
    """One row of MONITORING_SCHEMA: drift of the scores and, by column, of the features, and slices by column and value.

    The tables are those of :func:`prediction_drift`, :func:`feature_drift` and :func:`slice_performance`; all
    are of report size.
    """
    def by(name: str, value: Column) -> Column:
        entries = F.collect_list(F.struct(F.col(name).alias("key"), value.alias("value")))
        before = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
        return F.map_from_entries(F.array_sort(entries, before))

    columns = slices.groupBy("slice_column").agg(by("value", F.struct(*_SLICE_FIELDS)).alias("by_value"))
    thresholds = F.struct(F.lit(config.WATCH_PSI).alias("watch_psi"), F.lit(config.ALERT_PSI).alias("alert_psi"))
    parts = {
        "prediction_drift": prediction.select(F.struct("psi", "reference_mean", "current_mean", "status").alias("prediction_drift")),
        "feature_drift": features.agg(by("feature", F.struct(*_DRIFT_FIELDS)).alias("feature_drift")),
        "governance_slices": columns.agg(by("slice_column", F.col("by_value")).alias("governance_slices")),
    }
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values())
    return stacked.agg(*[F.first(name, ignorenulls=True).alias(name) for name in parts]).withColumn("thresholds", thresholds)


def monitoring_rows(document: DataFrame) -> DataFrame:
    """The document as (section, item, slice, field, value, text) rows; a field without a value has a row, too."""
    def rows(section: str, item: Column, value: Column, struct: Column, fields: list[str]) -> Column:
        none = F.lit(None)
        return F.array(*[
            F.struct(
                F.lit(section).alias("section"), item.alias("item"), value.alias("slice"), F.lit(f).alias("field"),
                (none if f == "status" else struct[f]).cast("double").alias("value"),
                (struct[f] if f == "status" else none).cast("string").alias("text"),
            )
            for f in fields
        ])

    none = F.lit(None).cast("string")
    features = F.transform(F.map_entries("feature_drift"), lambda e: rows("feature_drift", e["key"], none, e["value"], _DRIFT_FIELDS))
    slices = F.transform(F.map_entries("governance_slices"), lambda c: F.flatten(F.transform(
        F.map_entries(c["value"]), lambda e: rows("governance_slices", c["key"], e["key"], e["value"], _SLICE_FIELDS))))
    everything = F.concat(
        rows("prediction_drift", none, none, F.col("prediction_drift"), ["psi", "reference_mean", "current_mean", "status"]),
        F.flatten(features), F.flatten(slices),
        rows("thresholds", none, none, F.col("thresholds"), ["watch_psi", "alert_psi"]),
    )
    return document.select(F.inline(everything))


def report_payload(scored: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row: summary, models, risk_bands, calibration, disclaimer.

    ``scored`` has actual_default, default_probability and predicted_default;
    ``metrics`` is one row of METRICS_SCHEMA.
    """
    label, p = "actual_default", "default_probability"
    require_columns(scored, [label, p, "predicted_default"], "prediction columns")
    summary, bands, calibration = report_tables(pin(band_cells(scored, label, p)))
    place = F.array_position(F.array(*[F.lit(b) for b in config.BANDS]), F.col("band"))
    bands = bands.select(place.alias("place"), *bands.columns)
    calibration = calibration.select(
        "bin_index", "bin", "clients", "average_probability", "observed_default_rate"
    )
    one = document(
        {"scored": summary, "metrics": metrics},
        {"risk_bands": bands, "calibration": calibration},
    )
    return one.select(
        F.struct("scored.*", "metrics.selected_model", "metrics.selection_metric").alias("summary"),
        F.col("metrics.models").alias("models"),
        "risk_bands", "calibration", F.lit(DISCLAIMER).alias("disclaimer"),
    )


def write_report(spark: SparkSession, scored_path: str, metrics_path: str, destination: str) -> DataFrame:
    """Read scored rows and metrics, write the document, return it."""
    payload = report_payload(
        read_scored(spark, scored_path), read_json(spark, metrics_path, METRICS_SCHEMA)
    )
    write_json(payload.coalesce(1), destination)
    return payload


def payload_rows(payload: DataFrame) -> DataFrame:
    """The document's numbers as (section, item, field, value) rows."""
    def rows(section: str, struct, item, fields):
        return [
            F.struct(
                F.lit(section).alias("section"), item.alias("item"),
                F.lit(f).alias("field"), struct[f].cast("double").alias("value"),
            )
            for f in fields
        ]

    def unrolled(section: str, items: str, item: str, fields):
        each = F.transform(items, lambda s: F.array(*rows(section, s, s[item], fields)))
        return F.flatten(each)

    rates = ["clients", "observed_default_rate", "average_probability"]
    model_fields = ["roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score"]
    summary_fields = ["scored_rows", "observed_defaults", "default_rate", "average_probability"]
    everything = F.concat(
        F.array(*rows("summary", F.col("summary"), F.col("summary.selected_model"), summary_fields)),
        unrolled("models", "models", "name", model_fields),
        unrolled("risk_bands", "risk_bands", "band", rates),
        unrolled("calibration", "calibration", "bin", rates),
    )
    return payload.select(F.inline(everything))
