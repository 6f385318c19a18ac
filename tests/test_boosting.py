"""Boosting in blocks against the classifier, on tables small enough that both take thresholds from all rows."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from scorewright import config
from scorewright.operators import boosting, ensembles, features, models
from scorewright.plans import batch
from test_models import CATEGORICAL, NUMERIC, clients


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(boosting, "BLOCKS_FROM", 0)
    monkeypatch.setattr(boosting, "_BLOCK", 64)
    monkeypatch.setattr(boosting, "_ROWS_PER_TASK", (100, 10_000))


def prepared(df, numeric=NUMERIC, categorical=CATEGORICAL):
    done = features.fit_preparation(df, numeric, categorical).fit(df).transform(df).withColumn("label", F.col(config.TARGET))
    return done.select("row_id", "label", "features").localCheckpoint()


def gap(one, other, df):
    pairs = models.with_probability(one, df).join(models.with_probability(other, df, "q").select("row_id", "q"), "row_id")
    return pairs.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]


@pytest.mark.parametrize(
    "numeric, categorical, params",
    [
        (NUMERIC, CATEGORICAL, {}),
        (NUMERIC, [], dict(maxDepth=2, maxBins=8)),
        ([], CATEGORICAL, dict(maxDepth=7)),
        (NUMERIC, CATEGORICAL, dict(minInstancesPerNode=40, minInfoGain=0.01, stepSize=0.5)),
        (NUMERIC, CATEGORICAL, dict(checkpointInterval=-1, maxDepth=1)),
    ],
)
def test_blocks_grow_the_trees_of_the_classifier(spark, monkeypatch, numeric, categorical, params):
    rows = prepared(clients(spark, 500), numeric, categorical)
    booster = models.gradient_boosting("label", 12, **params)
    want = booster.fit(rows.coalesce(1))
    seen, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: seen.append(df.count()) or fit(self, df, *a))
    found = boosting.fit_boosting(booster, rows, 500)
    assert seen == [2]  # the classifier only lends the form of its model
    assert gap(found, want, rows) < 1e-9
    assert found.getNumTrees == 12 and found.treeWeights == want.treeWeights and found.numFeatures == want.numFeatures
    assert found.uid == want.uid and found.extractParamMap() == want.extractParamMap()


def test_model_in_blocks_is_saved_and_read_as_nodes(spark, tmp_path):
    df = clients(spark, 400).withColumnRenamed(config.TARGET, "label")
    fitted = models.fit_models(df, NUMERIC, CATEGORICAL, names=[config.CHALLENGER_MODEL], rounds=3)[config.CHALLENGER_MODEL]
    fitted.save(f"{tmp_path}/m")
    nodes = ensembles.ensemble_nodes(spark, f"{tmp_path}/m")
    rows = fitted.stages[0].transform(df)
    leaves = ensembles.leaf_table(rows, nodes).collect()
    assert len(leaves) > 2 and sum(r.rows for r in leaves) == 400
    assert all(r.rows == r.seen and abs(r.prediction - r.mean) < 1e-9 for r in leaves)
    again = ensembles.ensemble_probability(rows, nodes, "again").select("row_id", "again")
    scored = models.with_probability(PipelineModel.load(f"{tmp_path}/m"), df)
    assert scored.join(again, "row_id").filter("abs(p - again) > 1e-9").count() == 0


def test_partial_sums_may_be_added_on_executors(spark, monkeypatch):
    rows = prepared(clients(spark, 500))
    booster = models.gradient_boosting("label", 2)
    want = boosting.fit_boosting(booster, rows, 500)
    monkeypatch.setattr(boosting, "_PARTIALS", 1)
    assert gap(boosting.fit_boosting(booster, rows, 500), want, rows) < 1e-9


def test_constant_features_and_one_class_give_leaves(spark):
    rows = prepared(clients(spark, 100).withColumns({c: F.lit(1.0) for c in NUMERIC}), NUMERIC, [])
    found = boosting.fit_boosting(models.gradient_boosting("label", 2), rows, 100)
    assert [t.numNodes for t in found.trees] == [1, 1]
    one = prepared(clients(spark, 100).withColumn(config.TARGET, F.lit(1)))
    assert [t.numNodes for t in boosting.fit_boosting(models.gradient_boosting("label", 2), one, 100).trees] == [1, 1]


def test_rows_that_the_classifier_refuses_are_refused(spark):
    rows = prepared(clients(spark, 100))
    for bad in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="Labels of boosting"):
            boosting.fit_boosting(models.gradient_boosting("label", 1), rows.withColumn("label", bad), 100)


@pytest.mark.parametrize("rate, strategy", [(0.8, "all"), (1.0, "0.5"), (0.6, "0.3")])
def test_sampled_trees_by_brute_force(spark, monkeypatch, rate, strategy):
    """Leaves hold the drawn rows only, predict their mean residual and move the margins of all rows; cuts are the best of the drawn features."""
    rows = prepared(clients(spark, 500)).coalesce(1)
    booster = models.managed_boosting("label", 4, subsamplingRate=rate, featureSubsetStrategy=strategy, minInstancesPerNode=9)
    asked, best_cut = [], boosting._best_cut
    monkeypatch.setattr(boosting, "_best_cut", lambda *a: asked.append((a[0], set(map(int, a[3])), best_cut(*a))) or asked[-1][2])
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df, f=GBTClassifier._fit: f(self, df) if df.count() == 2 else pytest.fail("the classifier fitted"))
    found = boosting.fit_boosting(booster, rows, 500, sampled=True)
    held = rows.select("label", "features").collect()
    x, sign = np.array([r.features.toArray() for r in held]), np.array([2.0 * r.label - 1 for r in held])
    margin, seen, width = np.zeros(500), [], x.shape[1]
    for i, tree in enumerate(found.trees):
        drawn = np.ones(500, bool) if rate == 1.0 else np.concatenate([boosting._draws(rate, config.SEED, i)((0, k), len(sign[at : at + 64])) for k, at in enumerate(range(0, 500, 64))])
        seen.append(frozenset(np.flatnonzero(drawn)))
        residual = sign if i == 0 else 4 * sign / (1 + np.exp(2 * sign * margin))
        leaf = np.array([tree.predictLeaf(r.features) for r in held])
        predicted = np.array([tree.predict(r.features) for r in held])
        assert len(set(leaf)) > 2
        for n in set(leaf):
            mine = drawn & (leaf == n)
            assert mine.sum() >= 9 and predicted[leaf == n][0] == pytest.approx(residual[mine].mean())
        margin += found.treeWeights[i] * predicted
    nodes = [a for a in asked if a[2]]
    wanted = width if strategy == "all" else math.ceil(float(strategy) * width)
    assert all(len(f) == wanted for _, f, _ in asked) and all(cut[1][0] in f for _, f, cut in nodes)
    assert (len({frozenset(f) for _, f, _ in asked}) > 3) == (strategy != "all")
    assert (len(set(seen)) == 4 and all(abs(len(s) - 500 * rate) < 60 for s in seen)) if rate < 1 else len(set(seen)) == 1
    again = boosting.fit_boosting(booster, rows, 500, sampled=True)
    assert gap(again, found, rows) == 0 and found.extractParamMap() == booster.fit(rows.limit(2).coalesce(1), {booster.maxIter: 1}).extractParamMap() | {booster.maxIter: 4}


def test_one_subset_for_all_nodes_grows_the_classifiers_trees(spark, monkeypatch):
    rows = prepared(clients(spark, 500))
    width = len(rows.first().features)
    kept = sorted(np.random.default_rng(1).choice(width, math.ceil(0.5 * width), replace=False).tolist())
    best_cut = boosting._best_cut
    monkeypatch.setattr(boosting, "_best_cut", lambda node, a, b, features, *rest: best_cut(node, a, b, kept, *rest))
    found = boosting.fit_boosting(models.gradient_boosting("label", 6, featureSubsetStrategy="0.5"), rows, 500, sampled=True)
    without = F.udf(lambda v: Vectors.dense([a if i in kept else 0.0 for i, a in enumerate(v)]), VectorUDT())
    bare = rows.withColumn("features", without("features").alias("features", metadata=rows.schema["features"].metadata))
    assert gap(found, models.gradient_boosting("label", 6).fit(bare.coalesce(1)), bare) < 1e-9


def test_batch_flow_grows_its_trees_in_blocks(spark, tmp_path, monkeypatch):
    seen, fit = [], boosting._in_blocks
    monkeypatch.setattr(boosting, "_in_blocks", lambda booster, df, rows, kinds: seen.append((booster.getSubsamplingRate(), rows)) or fit(booster, df, rows, kinds))
    df = clients(spark, 600).withColumnRenamed(config.TARGET, "label")
    row = batch.batch_flow(df, str(tmp_path), numeric=NUMERIC, categorical=CATEGORICAL, rounds=3).first()
    assert seen == [(0.8, 420)] and row.rows == 90
    assert models.tree_count(PipelineModel.load(f"{tmp_path}/model")) == 3


def test_strategies_by_name_or_number_stay_with_the_classifier(spark, monkeypatch):
    monkeypatch.setattr(boosting, "_in_blocks", None)
    rows = prepared(clients(spark, 200))
    for strategy in ("sqrt", "log2", "onethird", "1"):
        assert boosting.fit_boosting(models.gradient_boosting("label", 1, featureSubsetStrategy=strategy), rows, 200, sampled=True).getNumTrees == 1


def test_other_settings_stay_with_the_classifier(spark, monkeypatch):
    monkeypatch.setattr(boosting, "_in_blocks", None)
    rows = prepared(clients(spark, 200))
    bare = rows.withColumn("features", F.col("features").alias("features", metadata={}))
    for booster, df in (
        (models.gradient_boosting("label", 1, subsamplingRate=0.5, seed=3), rows), (models.gradient_boosting("label", 1, featureSubsetStrategy="0.5"), rows),
        (models.gradient_boosting("label", 1, maxDepth=9), rows), (models.gradient_boosting("label", 1), bare),
    ):
        assert boosting.fit_boosting(booster, df, 200).getNumTrees == 1
    monkeypatch.setattr(boosting, "WIDEST_DENSE", 5)
    assert boosting.fit_boosting(models.gradient_boosting("label", 1), rows, 200).getNumTrees == 1
