"""Categories as a table, and importance from swapped terms."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorewright import config
from scorewright.operators import features, models, permutation
from scorewright.operators.quantiles import text_counts


def test_dictionary_numbers_texts_in_order(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("c", "x"), ("a", "é"), ("B", "")], "c string, d string")
    found = features.category_dictionary(text_counts(df, ["c", "d"]), rows_per_task=2).collect()
    assert sorted((r.feature, r.place, r.text) for r in found) == [("c", 0, "B"), ("c", 1, "a"), ("c", 2, "b"), ("c", 3, "c"), ("d", 0, ""), ("d", 1, "x"), ("d", 2, "é")]


@pytest.mark.parametrize("widest", [10_000, 0])
def test_both_ways_prepare_the_same_vectors(spark, tmp_path, widest):
    df = spark.createDataFrame([(1.0, "a'b", "x"), (2.0, "c", None), (3.0, "a'b", "y"), (None, None, "x")], "x double, c string, d string")
    model = features.fit_preparation(df, ["x"], ["c", "d"], dictionary=f"{tmp_path}/dictionary", widest=widest).fit(df)
    model.write().overwrite().save(f"{tmp_path}/model")
    other = spark.createDataFrame([(2.0, "zzz", "y"), (None, None, None)], df.schema)
    found = [v[0].toArray().tolist() for v in PipelineModel.load(f"{tmp_path}/model").transform(df.union(other)).select("features").collect()]
    deviation = np.std([1, 2, 3, 2])
    wanted = [[-1 / deviation, 1, 0, 1, 0], [0, 0, 1, 1, 0], [1 / deviation, 1, 0, 0, 1], [0, 1, 0, 1, 0], [0, 0, 0, 0, 1], [0, 1, 0, 1, 0]]
    assert np.allclose(sorted(found), sorted(wanted))


def test_a_column_of_a_hundred_thousand_values(spark, monkeypatch):
    """Half of the rows hold one value; labels stay off the driver and vectors are sparse."""
    n = 100_000
    df = spark.range(2 * n).select("id", F.when(F.col("id") < n, F.format_string("v%06d", F.col("id"))).otherwise(F.lit("v000007")).alias("c"))
    monkeypatch.setattr(features, "fit_categories", lambda *_: pytest.fail("labels were collected"))
    model = features.fit_preparation(df, [], ["c"], rows_per_task=30_000).fit(df)
    encoded = model.transform(df).select("id", "features")
    first = encoded.filter("id in (0, 7, 99999, 150000)").orderBy("id").collect()
    assert [(r.features.size, r.features.indices.tolist()) for r in first] == [(n, [0]), (n, [7]), (n, [99999]), (n, [7])]
    assert encoded.count() == 2 * n


def risky(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("row_id"), (F.rand(1) * 100).alias("x"), F.when(F.rand(2) < 0.9, F.floor(F.rand(3) * 3)).alias("few"),
        F.floor(F.rand(4) * 4).cast("string").alias("c"), F.when(F.rand(5) < 0.8, F.lit("only")).alias("d"),
        (F.rand(6) < 0.3).cast("int").alias("noise"),
    ).withColumn("label", ((F.col("c") == "2") | (F.col("x") > 80) & (F.col("noise") == 1)).cast("int"))


@pytest.mark.parametrize("per_column", [False, True])
def test_swapped_terms_give_the_same_importance(spark, monkeypatch, per_column):
    df = risky(spark)
    numeric, categorical = ["x", "few"], ["c", "d", "noise"]
    model = models.fit_models(df.filter("row_id >= 100 and c <> '3'"), numeric, categorical, names=[config.BASELINE_MODEL])[config.BASELINE_MODEL]
    want = permutation.permutation_importance(df, lambda t: models.with_probability(model, t), [*numeric, *categorical], per_column=per_column)
    passed, transform = [], PipelineModel.transform
    monkeypatch.setattr(PipelineModel, "transform", lambda self, frame: passed.append(frame.count()) or transform(self, frame))
    found = permutation.linear_importance(model, df, numeric, categorical, per_column=per_column)
    rows = {(r.feature, r.importance, r.position) for r in found.collect()}
    assert passed == [400]  # not 2 * 5 + 1 times as many
    monkeypatch.undo()
    assert rows == {(r.feature, r.importance, r.position) for r in want.collect()}
    assert max(rows, key=lambda r: r[1])[0] == "c"


def test_terms_add_up_to_the_margin(spark):
    df = risky(spark)
    model = models.fit_models(df, ["x", "few"], ["c", "d"], names=[config.BASELINE_MODEL])[config.BASELINE_MODEL]
    unseen = df.limit(5).withColumn("c", F.lit("new"))
    for frame in (df, unseen):
        terms = permutation.linear_terms(model, frame, ["x", "few"], ["c", "d"]).select("row_id", "terms")
        margins = model.transform(frame).select("row_id", vector_to_array("rawPrediction")[1].alias("margin"))
        total = F.aggregate("terms", F.lit(float(model.stages[-1].intercept)), lambda a, x: a + x)
        assert terms.join(margins, "row_id").filter(F.abs(total - F.col("margin")) > 1e-9).count() == 0
