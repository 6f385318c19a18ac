import numpy as np
import pytest
from odd import documents
from pyspark.sql import functions as F

from scorewright.llm.quality import NAMES, features, fit, fit_trees, score


def test_statistics_of_odd_texts(spark):
    texts = [r.text or "" for r in documents(spark).collect()]
    together = features(texts)
    assert together.shape == (len(texts), len(NAMES)) and np.isfinite(together).all()
    alone = np.vstack([features([t]) for t in texts])
    np.testing.assert_allclose(together, alone)  # a text's statistics do not depend on its neighbours
    assert not features([""]).any() and features([]).shape == (0, len(NAMES))


def test_trees_learn_and_arrays_are_walked_right():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.1)).astype(float)
    model = fit_trees(x[:2000], y[:2000])
    found = model.scores(x[2000:])
    assert ((found > 0.5) == y[2000:]).mean() > 0.95
    total = np.full(50, model.start)
    for f, t, v in zip(model.feature, model.threshold, model.value, strict=True):
        for i in range(50):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if x[2000 + i, f[node]] > t[node] else 1)
            total[i] += v[node - len(f)]
    np.testing.assert_allclose(found[:50], 1 / (1 + np.exp(-total)))


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(None, 0), (3, None)]])
def test_too_few_labels_give_one_score(spark, labels):
    model = fit(documents(spark), spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = score(documents(spark), model).collect()
    assert len(rows) == documents(spark).count() and len({r.score for r in rows}) == 1 and 0 <= rows[0].score <= 1


def test_held_out_accuracy(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    found = score(docs, fit(docs, labels))
    assert score(docs.limit(0), fit(docs, labels)).count() == 0
    wrong = found.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 5 == 0))
    assert found.count() == docs.count() and wrong.isEmpty()
    tested = found.join(labels, "doc_id").where("held_out")
    right = tested.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.95


def test_labels_of_held_out_rows_are_not_learnt(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (sorted(map(tuple, score(docs, fit(docs, x)).collect())) for x in (labels, turned))
    assert first == second
