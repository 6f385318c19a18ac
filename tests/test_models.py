import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from scorewright import config
from scorewright.operators import ensembles, features, models, permutation
from scorewright.operators.quantiles import text_counts
from scorewright.plans import batch, report, training
from scorewright.sources import tables


def clients(spark, n=600):
    """Random client rows with the dataset's column names; risk grows with pay_0."""
    base = spark.range(n).select(
        F.col("id").alias("row_id"),
        (F.rand(1) * 100).alias("limit_bal"), (F.rand(2) * 40 + 20).alias("age"),
        F.rand(3).alias("bill_amt1"), F.rand(4).alias("pay_amt1"),
        (F.floor(F.rand(5) * 2) + 1).cast("int").alias("sex"),
        F.floor(F.rand(6) * 4).cast("int").alias("pay_0"),
        F.rand(7).alias("u"),
    )
    return base.withColumn(config.TARGET, (F.col("u") < 0.05 + 0.25 * F.col("pay_0")).cast("int")).drop("u")


NUMERIC, CATEGORICAL = ["limit_bal", "age", "bill_amt1", "pay_amt1"], ["sex", "pay_0"]


def test_imputation_uses_interpolated_median_and_smallest_mode(spark):
    rows = [(1.0, "b"), (2.0, "a"), (4.0, "a"), (10.0, "b"), (None, None), (float("nan"), "c")]
    df = spark.createDataFrame(rows, "x double, c string")
    fill = features.fit_fill_values(df, ["x"], ["c"])
    assert fill.medians == {"x": 3.0} and fill.modes == {"c": "a"}
    assert features.fit_categories(text_counts(df, ["c"])) == {"c": ["a", "b", "c"]}
    assert [tuple(r) for r in features.impute(df, fill).collect()][4:] == [(3.0, "a"), (3.0, "c")]


def test_mode_ties_go_to_the_smallest_number(spark):
    df = spark.createDataFrame([(10,), (2,), (10,), (2,), (3,)], "c int")
    assert features.fit_fill_values(df, [], ["c"]).modes == {"c": "2"}


def test_nan_codes_are_missing_categories(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0,), (1.0,), (nan,), (nan,), (nan,), (2.0,), (None,)], "c double")
    fill = features.fit_fill_values(df, [], ["c"])
    assert fill.modes == {"c": "1.0"}
    assert sorted(r.c for r in features.impute(df, fill).collect()) == ["1.0"] * 6 + ["2.0"]
    assert features.fit_categories(text_counts(df, ["c"])) == {"c": ["1.0", "2.0"]}
    vectors = features.fit_preparation(df, [], ["c"]).fit(df).transform(df).collect()
    assert [r.features.toArray().tolist() for r in vectors].count([1.0, 0.0]) == 6


def test_free_texts_are_no_categories(spark):
    counts = text_counts(spark.range(30).select(F.col("id").cast("string").alias("c")), ["c"])
    with pytest.raises(ValueError, match="at most 20"):
        features.fit_categories(counts, widest=20)


def test_column_without_values_is_rejected(spark):
    with pytest.raises(ValueError, match="No known value"):
        features.fit_fill_values(spark.createDataFrame([(None,)], "x double"), ["x"], [])


def test_scaling_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, k double")
    scaled = features.standardize(df, features.fit_scale(df, ["x", "k"])).toPandas()
    assert np.allclose(scaled.x, (np.array([1, 2, 6]) - 3) / np.std([1, 2, 6]))
    assert list(scaled.k) == [0.0, 0.0, 0.0]


def test_prepared_vector(spark):
    df = spark.createDataFrame([(1.0, "a'b"), (2.0, "c"), (3.0, "a'b"), (None, None)], "x double, c string")
    model = features.fit_preparation(df, ["x"], ["c"]).fit(df)
    vectors = [v[0].toArray().tolist() for v in model.transform(df).select("features").collect()]
    deviation = np.std([1, 2, 3, 2])
    assert np.allclose(vectors, [[-1 / deviation, 1, 0], [0, 0, 1], [1 / deviation, 1, 0], [0, 1, 0]])
    unseen = model.transform(spark.createDataFrame([(2.0, "zzz")], df.schema)).first().features.toArray()
    assert unseen.tolist() == [0.0, 0.0, 0.0]


def test_ragged_categories(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "c string, d string")
    model = features.fit_preparation(df, [], ["c", "d"]).fit(df)
    assert model.transform(df).first().features.size == 5


def test_logistic_regression_solves_the_summed_ridge_problem(spark):
    """The gradient of sum(w * loss) + |coefficients|^2 / 2 vanishes at the solution."""
    df = clients(spark, 400)
    model = models.fit_models(df, NUMERIC, CATEGORICAL, label=config.TARGET, names=[config.BASELINE_MODEL])
    fitted = model[config.BASELINE_MODEL]
    rows = fitted.transform(df).select("features", config.TARGET).collect()
    x = np.array([r[0].toArray() for r in rows])
    y = np.array([r[1] for r in rows])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta, intercept = fitted.stages[-1].coefficients.toArray(), fitted.stages[-1].intercept
    p = 1 / (1 + np.exp(-(x @ beta + intercept)))
    assert np.abs(x.T @ (w * (p - y)) + beta).max() < 0.05
    assert abs((w * (p - y)).sum()) < 0.05


def test_one_class_cannot_be_trained_on(spark):
    df = clients(spark, 20).withColumn(config.TARGET, F.lit(0))
    with pytest.raises(ValueError, match="both classes"):
        models.fit_models(df, NUMERIC, CATEGORICAL, label=config.TARGET)


def test_train_and_evaluate(spark, tmp_path):
    folder = str(tmp_path)
    df = clients(spark)
    result = training.train_and_evaluate(df, folder, rounds=3)
    assert result.test_rows == 120
    assert [r.model for r in result.metrics.orderBy(F.desc("model")).collect()] == ["logistic_regression", "gradient_boosting"]
    assert result.importance.first().feature == "pay_0"
    assert {r.feature for r in result.feature_drift.collect()} == set(config.MONITORED_COLUMNS)
    assert {r.slice_column for r in result.slices.collect()} == {"sex"}
    saved = PipelineModel.load(f"{folder}/model")
    predictions = spark.read.parquet(f"{folder}/predictions")
    assert {"actual_default", "default_probability", "predicted_default", *NUMERIC} <= set(predictions.columns)
    again = models.with_probability(saved, predictions.drop("default_probability"), "q")
    joined = again.select("row_id", "q").join(predictions.select("row_id", "default_probability"), "row_id")
    assert joined.filter("abs(q - default_probability) > 1e-12").count() == 0
    document = spark.read.schema("selection_metric string, selected_model string, models array<struct<name: string>>,"
                                 " test struct<test_rows: bigint>, explainability struct<top_features: array<struct<feature: string, importance: double>>>,"
                                 " promotion struct<promote: boolean>").json(f"{folder}/metrics").first()
    assert document.selected_model == result.selected_model and document.test.test_rows == 120
    assert [m.name for m in document.models] == ["logistic_regression", "gradient_boosting"]
    assert document.explainability.top_features[0].feature == "pay_0"
    assert document.promotion.promote in (True, False)
    bundle = tables.read_json(spark, f"{folder}/monitoring", report.MONITORING_SCHEMA).first()
    assert bundle.prediction_drift.psi == result.prediction_drift.first().psi
    assert {c: d.psi for c, d in bundle.feature_drift.items()} == {r.feature: r.psi for r in result.feature_drift.collect()}
    assert {(c, v): s.rows for c, values in bundle.governance_slices.items() for v, s in values.items()} == {(r.slice_column, r.value): r.rows for r in result.slices.collect()}
    assert bundle.thresholds.alert_psi == config.ALERT_PSI
    entry = spark.read.parquet(f"{folder}/registry").first()
    assert entry.model == result.selected_model and len(entry.artifact_sha256) == 64


def test_batch_flow(spark, tmp_path):
    df = clients(spark, 400).withColumnRenamed(config.TARGET, "label")
    row = batch.batch_flow(df, str(tmp_path), numeric=NUMERIC, categorical=CATEGORICAL, rounds=12).first()
    assert row.rows == 60 and row.roc_auc > 0.6
    assert models.tree_count(PipelineModel.load(f"{tmp_path}/model")) == 12  # validation rows do not end it
    kept = spark.read.option("header", True).csv(f"{tmp_path}/predictions")
    assert kept.columns == ["row_id", "actual_default", "default_probability"] and kept.count() == 60
    manifest = spark.read.json(f"{tmp_path}/manifest")
    assert manifest.select("channel").distinct().count() == 4


def test_table_of_nodes_scores_like_the_model(spark, tmp_path):
    """Twelve rounds over sampled rows and columns, with splits by threshold and by category; unseen categories, too."""
    df = clients(spark, 400).withColumnRenamed(config.TARGET, "label")
    batch.batch_flow(df, str(tmp_path), numeric=NUMERIC, categorical=CATEGORICAL, rounds=12)
    nodes = ensembles.ensemble_nodes(spark, f"{tmp_path}/model")
    kinds = nodes.agg(F.countDistinct("tree").alias("trees"), F.count("threshold").alias("t"), F.count("categories").alias("c"), F.count("left").alias("inner")).first()
    assert kinds.trees == 12 and kinds.t > 0 and kinds.c > 0 and kinds.t + kinds.c == kinds.inner
    assert batch.largest_gap(spark, str(tmp_path), "limit_bal double, age double, bill_amt1 double, pay_amt1 double, sex int, pay_0 int") < 1e-9
    model = PipelineModel.load(f"{tmp_path}/model")
    strange = df.withColumn("pay_0", F.lit(77)).withColumn("age", F.lit(None).cast("double"))
    again = ensembles.ensemble_probability(model.stages[0].transform(strange), nodes, "again").select("row_id", "again")
    assert models.with_probability(model, strange).join(again, "row_id").filter("abs(p - again) > 1e-9").count() == 0


def test_leaves_of_the_first_tree_hold_means(spark, tmp_path):
    df = clients(spark, 400).withColumnRenamed(config.TARGET, "label")
    fitted = models.fit_models(df, NUMERIC, CATEGORICAL, names=[config.CHALLENGER_MODEL], rounds=1)[config.CHALLENGER_MODEL]
    PipelineModel(stages=fitted.stages[-1:]).save(f"{tmp_path}/m")
    prepared = fitted.stages[0].transform(df)
    leaves = ensembles.leaf_table(prepared, ensembles.ensemble_nodes(spark, f"{tmp_path}/m")).collect()
    assert len(leaves) > 2 and sum(r.rows for r in leaves) == 400
    assert all(r.rows == r.seen and abs(r.prediction - r.mean) < 1e-9 for r in leaves)


@pytest.mark.parametrize("per_column", [False, True])
def test_variants_of_a_row_are_scored_side_by_side(spark, monkeypatch, per_column):
    """Numbers only reach the ranking, one (place, repeat, p) per variant, with the importances of whole shuffled rows."""
    df = clients(spark, 300).withColumnRenamed(config.TARGET, "label")
    model = models.fit_models(df, NUMERIC, CATEGORICAL, names=[config.BASELINE_MODEL])[config.BASELINE_MODEL]
    columns, seen, table = [*CATEGORICAL, *NUMERIC], [], permutation.score_table
    want = permutation.permutation_importance(df, lambda t: models.with_probability(model, t), columns, per_column=per_column).collect()
    monkeypatch.setattr(permutation, "score_table", lambda scored, *a: seen.append(scored) or table(scored, *a))
    found = permutation.linear_importance(model, df, NUMERIC, CATEGORICAL, order=columns, per_column=per_column).collect()
    assert dict(seen[0].dtypes) == {"label": "int", "repeat": "int", "place": "int", "p": "double"}
    assert seen[0].groupBy("place").count().count() == 7 and seen[0].count() == 300 * (1 + 6 * config.PERMUTATION_REPEATS)
    assert {r.feature: (r.position, r.importance) for r in found} == {r.feature: (r.position, pytest.approx(r.importance, abs=2e-6)) for r in want}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_trees_are_scored_in_batches_like_the_model(spark, tmp_path):
    """Trees of more than 32 leaves are put together from smaller ones; a tree may be a single leaf."""
    df = clients(spark, 3000).withColumn("label", (F.col(config.TARGET) + F.floor(F.col("age") * 7) % 2 > 0).cast("int"))
    prepared = features.fit_preparation(df, NUMERIC, CATEGORICAL).fit(df).transform(df)
    for name, params in {"deep": dict(maxDepth=8), "flat": dict(maxDepth=0)}.items():
        model = PipelineModel(stages=[models.gradient_boosting("label", 3, **params).fit(prepared)])
        model.save(f"{tmp_path}/{name}")
        nodes = ensembles.ensemble_nodes(spark, f"{tmp_path}/{name}")
        leaves = [r["count"] for r in nodes.filter("left is null").groupBy("tree").count().collect()]
        assert max(leaves) > 32 if name == "deep" else max(leaves) == 1
        again = ensembles.ensemble_probability(prepared.select("row_id", "features"), nodes, "again")
        assert "ArrowEvalPython" in plan(again) and "aggregate(" not in plan(again)  # no tree is interpreted row by row
        assert models.with_probability(model, prepared).join(again, "row_id").filter("abs(p - again) > 1e-9").count() == 0


def test_importances_of_boosting_come_from_the_table_of_nodes(spark, tmp_path, monkeypatch):
    seen, importance = [], training.permutation_importance
    monkeypatch.setattr(training, "select_model", lambda metrics, order: metrics.selectExpr("'gradient_boosting' as selected_model").limit(1))
    monkeypatch.setattr(training, "permutation_importance", lambda t, score, *a, **o: seen.append((t, score, a, o)) or importance(t, score, *a, **o))
    result = training.train_and_evaluate(clients(spark, 300), str(tmp_path), rounds=3)
    (test, score, a, o), = seen
    assert "ArrowEvalPython" in plan(score(test))
    monkeypatch.setattr(training, "WIDEST_DENSE", 3)  # wide vectors stay sparse
    assert "ArrowEvalPython" not in plan(score(test))
    want = importance(test, lambda t: models.with_probability(result.models["gradient_boosting"], t), *a, **o)
    assert {(r.feature, r.importance) for r in result.importance.collect()} == {(r.feature, r.importance) for r in want.collect()}
