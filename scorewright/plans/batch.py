"""Batch flow: write channels, train on them, score the unlabelled one, evaluate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..operators.boosting import fit_boosting
from ..operators.ensembles import ensemble_nodes, ensemble_probability
from ..operators.features import fit_preparation
from ..operators.metrics import ranking_metrics
from ..operators.models import in_tasks, managed_boosting, with_probability
from ..sources import channels
from ..sources.tables import read_csv, write_csv, write_json
from ..storage import discard, materialize, materialize_checked, shared_folder


def evaluate_scores(labels: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: rows, ROC-AUC and average precision of scores that arrived as a file."""
    return ranking_metrics(channels.align_scores(labels, scores))


def train_on_channels(
    spark, folder: str, features: str, numeric: Sequence[str], categorical: Sequence[str],
    *, rounds: int = 180, label: str = "label", early_stop: bool = False,
) -> PipelineModel:
    """Boosting on the train channel for all rounds; with ``early_stop`` the validation channel may end it."""
    shared_folder(spark)  # boosting checkpoints there
    train = channels.labeled_channel(spark, folder, "train", features, label)
    preparation = fit_preparation(train, numeric, categorical).fit(train)
    rows = train.withColumn("is_validation", F.lit(False))
    if early_stop:
        validation = channels.labeled_channel(spark, folder, "validation", features, label)
        rows = rows.union(validation.withColumn("is_validation", F.lit(True)))
    prepared, seen = materialize_checked(preparation.transform(rows).select(label, "is_validation", "features"))
    booster = fit_boosting(managed_boosting(label, rounds, early_stop), in_tasks(prepared, seen["rows"]), seen["rows"], sampled=True)
    discard(prepared)
    return PipelineModel(stages=[preparation, booster])


def score_channel(spark, folder: str, model_path: str, features: str, destination: str) -> None:
    """Score the unlabelled channel with a saved model; writes (key, p), no header."""
    rows = channels.held_out_channel(spark, folder, features)
    scored = with_probability(PipelineModel.load(model_path), rows)
    write_csv(scored.select(config.ROW_ID, "p"), destination, header=False)


def largest_gap(spark, folder: str, features: str) -> float:
    """How far the scores that a batch flow wrote are from those of the model's table of nodes, over the whole channel."""
    rows = channels.held_out_channel(spark, f"{folder}/channels", features)
    prepared = PipelineModel.load(f"{folder}/model").stages[0].transform(rows)
    again = ensemble_probability(prepared, ensemble_nodes(spark, f"{folder}/model"), "again").select(config.ROW_ID, "again")
    scores = channels.read_headerless(spark, f"{folder}/scores", f"{config.ROW_ID} bigint, p double")
    gap = F.abs(F.coalesce(F.col("p") - F.col("again"), F.lit(1.0)))  # a row on one side only is far off
    return scores.join(again, config.ROW_ID, "full_outer").agg(F.max(gap).alias("gap")).first().gap


def batch_flow(
    df: DataFrame, folder: str, *, numeric: Sequence[str], categorical: Sequence[str],
    rounds: int = 180, label: str = "label", seed: int = config.SEED,
) -> DataFrame:
    """From a labelled table to the evaluation of its held-out part: rows, positives and ranking metrics.

    The split is stored once, by channel. ``folder`` gets channels, manifest, model, scores and predictions.
    """
    spark = df.sparkSession
    names = [*numeric, *categorical]
    types = dict(df.dtypes)
    ddl = ", ".join(f"{c} {types[c]}" for c in names)
    split = materialize(channels.channel_split(df.select(config.ROW_ID, label, *names), label, seed=seed), partition_by="split")
    source = f"{folder}/channels"
    channels.write_channels(split, source, names, label)
    write_json(channels.manifest(spark, split, source, names, label), f"{folder}/manifest")

    model = train_on_channels(spark, source, ddl, numeric, categorical, rounds=rounds, label=label)
    model.write().overwrite().save(f"{folder}/model")
    score_channel(spark, source, f"{folder}/model", ddl, f"{folder}/scores")

    scores = channels.read_headerless(spark, f"{folder}/scores", f"{config.ROW_ID} bigint, p double")
    labels = channels.test_labels(spark, source, label).withColumnRenamed(label, "label")
    aligned = channels.align_scores(labels, scores).select(
        config.ROW_ID, F.col("label").alias("actual_default"), F.col("p").alias("default_probability")
    )
    write_csv(aligned, f"{folder}/predictions")
    kept = read_csv(spark, f"{folder}/predictions", aligned.schema)
    return ranking_metrics(kept, (), "actual_default", "default_probability")
