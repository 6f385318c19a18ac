"""The values that fitted models return, against brute force on the smallest tables."""

from functools import partial

import __spark_entry__ as entry
import numpy as np
import pytest
from pyspark.ml import PipelineModel

from scorewright import config
from scorewright.operators import models, sampling
from scorewright.plans import batch, queries, training
from test_metrics import slow_auc, slow_average_precision


@pytest.fixture(autouse=True)
def few_rounds(monkeypatch):
    monkeypatch.setattr(queries.models, "fit_models", partial(models.fit_models, rounds=5))
    monkeypatch.setattr(queries.training, "train_and_evaluate", partial(training.train_and_evaluate, rounds=5))
    monkeypatch.setattr(queries.batch, "batch_flow", partial(batch.batch_flow, rounds=5))


def slow_metrics(rows):
    y, p = (np.array(x) for x in zip(*rows))
    tp, fp, fn = (int((a & b).sum()) for a, b in (((y == 1), p >= 0.5), ((y == 0), p >= 0.5), ((y == 1), p < 0.5)))
    precision, recall = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn)
    return {
        "roc_auc": slow_auc(rows), "pr_auc": slow_average_precision(rows), "brier_score": float(((p - y) ** 2).mean()),
        "precision": precision, "recall": recall, "f1": 2 * precision * recall / (precision + recall) if tp else 0.0,
    }


def same(row, rows):
    for name, value in slow_metrics(rows).items():
        assert row[name] == pytest.approx(value, abs=2e-6), name


def fixed(spark, sf, monkeypatch, name):
    """The query's own fit, made once."""
    made = queries._fit_and_test(spark, sf, name)
    monkeypatch.setattr(queries, "_fit_and_test", lambda *_: made)
    return made


def scores(model, df):
    return [(r.label, r.p) for r in models.with_probability(model, df).select("label", "p").collect()]


def test_importances(spark, sf, monkeypatch):
    model, _, test = fixed(spark, sf, monkeypatch, config.BASELINE_MODEL)
    columns = [*queries.NUMERIC, *queries.CATEGORICAL]
    given = sampling.seeded_donors(test.select("row_id", "label", *columns), columns).collect()
    base = slow_average_precision(scores(model, test))
    want = {}
    for c in columns:
        losses = []
        for repeat in sorted({r.repeat for r in given}):
            rows = [(r.row_id, r.label, *[r.donor[x] if x == c else r[x] for x in columns]) for r in given if r.repeat == repeat]
            losses.append(base - slow_average_precision(scores(model, spark.createDataFrame(rows, test.select("row_id", "label", *columns).schema))))
        want[c] = sum(losses) / len(losses)
    found = {r.feature: r.importance for r in entry.queries()["permutation_importance_model"](spark, sf).collect()}
    assert found == pytest.approx(want, abs=2e-6) and max(found.values()) > 0.01


def test_boosting_metrics(spark, sf, monkeypatch):
    model, _, test = fixed(spark, sf, monkeypatch, config.CHALLENGER_MODEL)
    row, = entry.queries()["train_boosting"](spark, sf).collect()
    same(row, scores(model, test))
    assert row.trees == 5


def test_evaluated_metrics_and_selected_model(spark, sf, monkeypatch):
    kept = []
    flow = queries.training.train_and_evaluate
    monkeypatch.setattr(queries.training, "train_and_evaluate", lambda df, folder, **o: kept.append((df, flow(df, folder, **o))) or kept[-1][1])
    rows = entry.queries()["train_and_evaluate"](spark, sf).collect()
    df, done = kept[0]
    test = sampling.stratified_split(df, sampling.two_way, label="label").where("split = 'test'")
    for row in rows:
        same(row, scores(done.models[row.model], test))
    assert [r.model for r in rows if r.selected] == [max(rows, key=lambda r: r.pr_auc).model]


def test_batch_metrics(spark, sf, monkeypatch):
    folders = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, n, f=queries.scratch_path: folders.append(f(s, n)) or folders[-1])
    row, = entry.queries()["batch_flow"](spark, sf).collect()
    kept = spark.read.option("header", True).csv(f"{folders[0]}/predictions").collect()
    rows = [(int(r.actual_default), float(r.default_probability)) for r in kept]
    want = slow_metrics(rows)
    assert row.rows == len(rows) and row.roc_auc == pytest.approx(want["roc_auc"], abs=2e-6)
    assert row.pr_auc == pytest.approx(want["pr_auc"], abs=2e-6)
    assert models.tree_count(PipelineModel.load(f"{folders[0]}/model")) == 5
    assert row.trees == 5 and row.largest_gap == 0.0
