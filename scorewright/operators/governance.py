"""Promotion checks between a champion and a challenger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


def promotion_checks(
    metrics: DataFrame,
    champion: str = config.BASELINE_MODEL,
    challenger: str = config.CHALLENGER_MODEL,
    policy: config.PromotionPolicy | None = None,
) -> DataFrame:
    """One row: each check, whether all hold, and the policy used.

    ``metrics`` has one row per model. The pair is read with one aggregation,
    not a join.
    """
    policy = policy or config.PromotionPolicy()

    def of(model: str, metric: str):
        return F.max(F.when(F.col("model") == model, F.col(metric)))

    def gain(metric: str):
        return of(challenger, metric) - of(champion, metric)

    checks = metrics.agg(
        (gain("pr_auc") >= F.lit(policy.minimum_pr_auc_gain)).alias("pr_auc_gain"),
        (gain("brier_score") <= F.lit(policy.maximum_brier_degradation)).alias("calibration"),
        (of(challenger, "recall") >= F.lit(policy.minimum_recall)).alias("minimum_recall"),
    )
    return checks.select(
        (F.col("pr_auc_gain") & F.col("calibration") & F.col("minimum_recall")).alias("promote"),
        "*",
        F.lit(policy.minimum_pr_auc_gain).alias("policy_minimum_pr_auc_gain"),
        F.lit(policy.maximum_brier_degradation).alias("policy_maximum_brier_degradation"),
        F.lit(policy.minimum_recall).alias("policy_minimum_recall"),
        F.lit(config.ROLLBACK_TRIGGER).alias("rollback_trigger"),
    )
