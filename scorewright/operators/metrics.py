"""Ranking and threshold metrics, grouped, from one pass over the scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import ratio, sql_number
from .running import running_totals

# Aggregates over a score table: rows `n` and positives `pos` per score `p`,
# and their totals `n_upto`, `pos_upto` from the highest score down.

# Step sum of precision over recall gains; 0 without positives.
AVERAGE_PRECISION = ratio("sum(pos * (cast(pos_upto as double) / n_upto))", "sum(pos)")
# Share of (positive, negative) pairs in order, ties counting half; null for one class.
ROC_AUC = (
    "try_divide(sum((n - pos) * (pos_upto - pos / 2D)),"
    " cast(sum(pos) as double) * (sum(n) - sum(pos)))"
)
BRIER = "sum(pos * pow(1D - p, 2D) + (n - pos) * pow(p, 2D)) / sum(n)"


def confusion_counts(threshold: float = config.DECISION_THRESHOLD) -> dict[str, str]:
    yes = f"(where p >= {sql_number(threshold)})"
    no = f"(where p < {sql_number(threshold)})"
    cells = {"tn": ("n - pos", no), "fp": ("n - pos", yes), "fn": ("pos", no), "tp": ("pos", yes)}
    return {name: f"coalesce(sum({rows}) filter {where}, 0L)" for name, (rows, where) in cells.items()}


def threshold_expressions(threshold: float = config.DECISION_THRESHOLD) -> dict[str, str]:
    """precision, recall and f1 (0 where undefined), and the Brier score."""
    m = confusion_counts(threshold)
    tp, wrong = m["tp"], f"{m['fp']} + {m['fn']}"
    return {
        "precision": ratio(tp, f"{tp} + {m['fp']}"),
        "recall": ratio(tp, f"{tp} + {m['fn']}"),
        "f1": ratio(f"2 * {tp}", f"2 * {tp} + {wrong}"),
        "brier_score": BRIER,
    }


def _rounded(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(f"round({e}, 6)").alias(name) for name, e in expressions.items()]


def score_table(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", p: str = "p"
) -> DataFrame:
    """One row per group and distinct score: rows ``n`` and positives ``pos``.

    Partial aggregation folds hot groups and tied scores before the shuffle.
    """
    return scored.groupBy(*by, F.col(p).alias("p")).agg(
        F.expr("count(*)").alias("n"), F.expr(f"sum(cast(`{label}` as bigint))").alias("pos")
    )


def _one_per_row(scored: DataFrame, by: Sequence[str], label: str, p: str) -> DataFrame:
    """Rows as a score table of single rows, so that counts need no shuffle by score. Missing scores are refused."""
    checked = f"if(`{p}` is null or isnan(`{p}`), cast(raise_error('Scores must not be missing') as double), `{p}`)"
    return scored.select(
        *by, F.expr(checked).alias("p"), F.lit(1).cast("long").alias("n"), F.expr(f"cast(`{label}` as bigint)").alias("pos")
    )


def ranked_scores(table: DataFrame, by: Sequence[str] = (), **options) -> DataFrame:
    """The score table, computed once, with totals from the highest score down."""
    return running_totals(
        table, by, "p", ["n", "pos"], descending=True,
        reject=("p is null or isnan(p)", "Scores must not be missing"), **options,
    )


def confusion_matrix(scored: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Long form: always the four (actual, predicted) cells."""
    m = confusion_counts()
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = ", ".join(f"struct({y} as actual, {d} as predicted, {m[c]} as rows)" for y, d, c in cells)
    counted = _one_per_row(scored, (), label, p).agg(F.expr(f"array({rows})").alias("cells"))
    return counted.select(F.inline("cells"))


def threshold_metrics(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", p: str = "p"
) -> DataFrame:
    """precision, recall, F1 and Brier score per group, from one pass without a shuffle by score."""
    return _one_per_row(scored, by, label, p).groupBy(*by).agg(*_rounded(threshold_expressions()))


def ranking_metrics(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", p: str = "p", **options
) -> DataFrame:
    """Rows, ROC-AUC and average precision per group."""
    ranked = ranked_scores(score_table(scored, by, label, p), by, **options)
    return ranked.groupBy(*by).agg(
        F.sum("n").alias("rows"), *_rounded({"roc_auc": ROC_AUC, "pr_auc": AVERAGE_PRECISION})
    )


def classification_metrics(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", p: str = "p", **options
) -> DataFrame:
    """The full bundle per group, with the 2x2 matrix (rows: actual, columns: predicted)."""
    ranked = ranked_scores(score_table(scored, by, label, p), by, **options)
    m = confusion_counts()
    matrix = f"array(array({m['tn']}, {m['fp']}), array({m['fn']}, {m['tp']}))"
    return ranked.groupBy(*by).agg(
        *_rounded({"roc_auc": ROC_AUC, "pr_auc": AVERAGE_PRECISION, **threshold_expressions()}),
        F.expr(matrix).alias("confusion_matrix"),
    )


def select_model(metrics: DataFrame, order: Sequence[str], metric: str = config.SELECTION_METRIC) -> DataFrame:
    """The model with the highest (rounded) metric; ties go to the one named first."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return metrics.agg(
        F.max_by("model", F.struct(F.col(metric), -place)).alias("selected_model"),
        F.max(metric).alias(metric),
    ).withColumn("selection_metric", F.lit(metric))
