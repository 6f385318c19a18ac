"""Train, compare, explain, monitor, persist."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import decision
from ..operators.drift import feature_drift, prediction_drift
from ..operators.ensembles import WIDEST_DENSE, ensemble_nodes, ensemble_probability
from ..operators.governance import promotion_checks
from ..operators.metrics import classification_metrics, select_model
from ..operators.models import fit_models, with_probability
from ..operators.permutation import linear_importance, permutation_importance, top_features
from ..operators.sampling import stratified_split, two_way
from ..operators.schema import partition_columns
from ..operators.slices import present, slice_performance
from ..sources import registry
from ..sources.tables import read_scored, write_json, write_scored
from ..storage import materialize, pin
from .report import metrics_document, monitoring_document


@dataclass(frozen=True)
class TrainingResult:
    selected_model: str
    metrics: DataFrame
    importance: DataFrame
    promotion: DataFrame
    feature_drift: DataFrame
    prediction_drift: DataFrame
    slices: DataFrame
    test_rows: int
    default_rate: float
    folder: str
    models: dict[str, PipelineModel]


def _scored_by_all(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    scored = [with_probability(model, test).withColumn("model", F.lit(name)) for name, model in models.items()]
    return reduce(DataFrame.union, scored)


def compare_models(models: dict[str, PipelineModel], test: DataFrame, label: str) -> DataFrame:
    """Metrics of every model on the same rows, in one job."""
    return classification_metrics(_scored_by_all(models, test).select("model", label, "p"), ["model"], label)


def train_and_evaluate(
    df: DataFrame,
    folder: str,
    *,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    label: str = config.TARGET,
    monitored: Sequence[str] = config.MONITORED_COLUMNS,
    slices: Sequence[str] = config.SLICE_COLUMNS,
    rounds: int = 180,
    seed: int = config.SEED,
    policy: config.PromotionPolicy | None = None,
) -> TrainingResult:
    """The whole flow over a table with a unique ``row_id``; results go below ``folder``.

    Without ``numeric`` and ``categorical``, all columns are features, and the
    configured ones of them are categorical.
    """
    spark = df.sparkSession
    inputs = [c for c in df.columns if c not in (config.ROW_ID, label)]
    if numeric is None or categorical is None:
        found = partition_columns(inputs)
        numeric = found[0] if numeric is None else numeric
        categorical = [c for c in found[1] if c not in numeric] if categorical is None else categorical
    features = [c for c in inputs if c in numeric or c in categorical]
    extra = [c for c in present([*monitored, *slices], df) if c not in features]
    split = materialize(
        stratified_split(df.select(config.ROW_ID, label, *features, *extra), two_way, label=label, seed=seed),
        partition_by="split",
    )
    train = split.filter(F.col("split") == "train").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")
    models = fit_models(train, numeric, categorical, label=label, rounds=rounds)
    order = list(models)

    # Every model scores the test rows once, the selected one also the training rows.
    tested = materialize(_scored_by_all(models, test), partition_by="model")
    metrics = pin(classification_metrics(tested, ["model"], label))  # one row per model
    selected = select_model(metrics, order).first().selected_model
    model = models[selected]
    model.write().overwrite().save(f"{folder}/model")

    scored_path = f"{folder}/predictions"
    scored = tested.filter(F.col("model") == selected).drop("model").withColumnRenamed("p", "default_probability")
    write_scored(
        scored.withColumnRenamed(label, "actual_default")
        .withColumn("predicted_default", decision("default_probability")),
        scored_path,
    )
    scored = read_scored(spark, scored_path).withColumnRenamed("default_probability", "p")

    if selected == config.BASELINE_MODEL:
        losses = linear_importance(model, test, numeric, categorical, order=features, label=label, seed=seed)
    else:
        def score(rows: DataFrame) -> DataFrame:
            if model.stages[-1].numFeatures > WIDEST_DENSE:
                return with_probability(model, rows)
            return ensemble_probability(model.stages[0].transform(rows), ensemble_nodes(spark, f"{folder}/model"))

        losses = permutation_importance(test, score, features, label=label, seed=seed)
    importance = pin(top_features(losses))
    promotion = promotion_checks(metrics, policy=policy)
    by_feature = pin(feature_drift(train, test, monitored))
    trained = materialize(with_probability(model, train).select("p"))
    by_score = pin(prediction_drift(trained, scored.select("p")))
    by_slice = pin(slice_performance(scored, slices, "actual_default"))
    base = scored.agg(F.count(F.lit(1)).alias("n"), F.avg("actual_default").alias("rate")).first()

    explained = importance.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(-F.col("importance"), "position", "feature", "importance"))),
            lambda s: F.struct(s["feature"].alias("feature"), s["importance"].alias("importance")),
        ).alias("top_features")
    )
    tested = scored.agg(
        F.count(F.lit(1)).alias("test_rows"), F.round(F.avg("actual_default"), 6).alias("test_default_rate")
    )
    write_json(
        metrics_document(metrics, order, test=tested, explainability=explained, promotion=promotion).coalesce(1),
        f"{folder}/metrics",
    )
    write_json(monitoring_document(by_score, by_feature, by_slice).coalesce(1), f"{folder}/monitoring")
    registry.append(registry.registry_entry(metrics, selected, f"{folder}/model"), f"{folder}/registry")
    registry.append(registry.run_log(metrics, selected), f"{folder}/run_log")
    return TrainingResult(
        selected, metrics, importance, promotion, by_feature, by_score, by_slice, base.n, base.rate, folder, models
    )
