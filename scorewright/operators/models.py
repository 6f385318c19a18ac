"""The two classifiers, and scoring with a fitted one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..storage import discard, materialize_checked, shared_folder
from .boosting import fit_boosting
from .features import fit_preparation

_WEIGHT = "_class_weight"

# Rows that a task of a fit should hold at least.
ROWS_PER_FIT_TASK = 50_000


def logistic_regression(rows: int, label: str = "label") -> LogisticRegression:
    """Class-balanced, ridge penalty 1 on the summed loss (MLlib averages it, hence 1 / rows)."""
    return LogisticRegression(
        featuresCol="features", labelCol=label, weightCol=_WEIGHT, maxIter=2000,
        regParam=1.0 / rows, elasticNetParam=0.0, standardization=False,
    )


def gradient_boosting(label: str = "label", rounds: int = 180, **params) -> GBTClassifier:
    """The challenger. Residuals are checkpointed every ten rounds, so lineage stays short."""
    settings = dict(stepSize=0.07, maxDepth=5, maxBins=64, seed=config.SEED, checkpointInterval=10)
    return GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=rounds, **{**settings, **params}
    )


def managed_boosting(label: str = "label", rounds: int = 180, early_stop: bool = False, **params) -> GBTClassifier:
    """The configuration of the batch flow: row and column sampling, all rounds.

    ``early_stop`` ends when rows marked ``is_validation`` gain no more.
    """
    settings = dict(subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=5)
    if early_stop:
        settings |= dict(validationIndicatorCol="is_validation", validationTol=0.001)
    return gradient_boosting(label, rounds, **{**settings, **params})


def in_tasks(df: DataFrame, rows: int, per_task: int = ROWS_PER_FIT_TASK) -> DataFrame:
    """``df`` in no more partitions than its rows need; boosting runs a job per level of every tree."""
    return df.coalesce(max(1, -(-rows // per_task)))


def tree_count(model: PipelineModel) -> int:
    """Trees of a fitted pipeline; 0 for other models than boosting."""
    return getattr(model.stages[-1], "getNumTrees", 0)


def penalised_gradient(model: PipelineModel, weighted: DataFrame, rows: int, label: str = "label") -> DataFrame:
    """``term``, ``gradient``: the logistic objective's slope at the solution, per row.

    Terms are the positions of the coefficients and -1 for the intercept. At
    the optimum every slope is zero.
    """
    fitted = model.stages[-1]
    penalty = [0.0, *[fitted.getRegParam() * float(b) for b in fitted.coefficients]]
    pull = F.col(_WEIGHT) * (vector_to_array("probability")[1] - F.col(label))
    terms = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))
    slopes = (
        model.transform(weighted).select(pull.alias("pull"), F.posexplode(terms).alias("term", "x"))
        .groupBy("term").agg((F.sum(F.col("pull") * F.col("x")) / rows).alias("slope"))
    )
    return slopes.select((F.col("term") - 1).alias("term"), (F.col("slope") + F.get(F.array(*map(F.lit, penalty)), F.col("term"))).alias("gradient"))


def balanced_weight(rows: int, positives: int, label: str = "label") -> Column:
    """Rows / (2 * rows of the class), from the counts of a training table."""
    if positives in (0, rows):
        raise ValueError("Training data needs both classes")
    return F.when(F.col(label) == 1, F.lit(rows / (2.0 * positives))).otherwise(F.lit(rows / (2.0 * (rows - positives))))


def balanced_weights(train: DataFrame, label: str = "label") -> tuple[DataFrame, int]:
    """Add :func:`balanced_weight`; also the row count."""
    counts = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")).first()
    return train.withColumn(_WEIGHT, balanced_weight(counts.n, counts.pos or 0, label)), counts.n


def fit_models(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    *,
    label: str = "label",
    rounds: int = 180,
    names: Sequence[str] = (config.BASELINE_MODEL, config.CHALLENGER_MODEL),
) -> dict[str, PipelineModel]:
    """Named, ordered pipelines from raw columns to probability. Preparation is fitted once; classes are counted in its stored result."""
    shared_folder(train.sparkSession)  # boosting checkpoints there
    preparation = fit_preparation(train, numeric, categorical).fit(train)
    stored, seen = materialize_checked(preparation.transform(train).select(label, "features"), positives=f"sum(cast(`{label}` as long))")
    rows = seen["rows"]
    prepared = in_tasks(stored.withColumn(_WEIGHT, balanced_weight(rows, seen["positives"] or 0, label)), rows)
    fits: dict[str, Callable[[], Model]] = {
        config.BASELINE_MODEL: lambda: logistic_regression(rows, label).fit(prepared),
        config.CHALLENGER_MODEL: lambda: fit_boosting(gradient_boosting(label, rounds), prepared, rows),
    }
    fitted = {name: PipelineModel(stages=[preparation, fits[name]()]) for name in names}
    discard(stored)
    return fitted


def with_probability(model: PipelineModel, df: DataFrame, p: str = "p") -> DataFrame:
    """``df`` with the probability of class 1; intermediate columns are dropped."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(p))
