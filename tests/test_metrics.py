import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorewright.operators import governance, metrics, slices
from scorewright.operators.running import running_totals


def frame(spark, rows, ddl="label int, p double"):
    return spark.createDataFrame(rows, ddl)


def slow_average_precision(rows):
    positives = sum(y for y, _ in rows)
    total = 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        at = sum(y for y, p in rows if p == t)
        upto = [y for y, p in rows if p >= t]
        total += at / positives * (sum(upto) / len(upto))
    return total


def slow_auc(rows):
    pos = [p for y, p in rows if y]
    neg = [p for y, p in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def random_rows(seed, n, ties):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        p = round(rng.random(), 2 if ties else 12)
        out.append((int(rng.random() < 0.2 + 0.5 * p), p))
    return out


def test_perfect_scores(spark):
    row = metrics.classification_metrics(frame(spark, [(0, .1), (0, .4), (1, .7), (1, .9)])).first()
    assert (row.roc_auc, row.recall, row.pr_auc) == (1.0, 1.0, 1.0)
    assert row.confusion_matrix == [[2, 0], [0, 2]]


@pytest.mark.parametrize("ties", [True, False])
@pytest.mark.parametrize("rows_per_task", [10**6, 100])
def test_ranking_metrics_match_the_slow_ones(spark, ties, rows_per_task):
    rows = random_rows(7, 400, ties)
    row = metrics.ranking_metrics(frame(spark, rows), rows_per_task=rows_per_task).first()
    assert row.rows == 400
    assert row.pr_auc == round(slow_average_precision(rows), 6)
    assert row.roc_auc == round(slow_auc(rows), 6)
    exact = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0)
    assert row.roc_auc == pytest.approx(exact.evaluate(frame(spark, [(float(y), p) for y, p in rows], "label double, p double")), abs=1e-6)


def test_threshold_includes_the_half_and_undefined_ratios_are_zero(spark):
    row = metrics.classification_metrics(frame(spark, [(1, .5), (0, .2)])).first()
    assert row.confusion_matrix == [[1, 0], [0, 1]]
    row = metrics.classification_metrics(frame(spark, [(1, .4), (0, .2)])).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)
    assert row.brier_score == round((.36 + .04) / 2, 6)


def test_one_class_has_no_auc(spark):
    row = metrics.classification_metrics(frame(spark, [(0, .4), (0, .2)])).first()
    assert row.roc_auc is None and row.pr_auc == 0.0


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_scores_are_rejected(spark, bad):
    with pytest.raises(ValueError, match="missing"):
        metrics.classification_metrics(frame(spark, [(0, .4), (1, bad)]))
    for entry_point in (metrics.confusion_matrix, metrics.threshold_metrics):
        with pytest.raises(Exception, match="must not be missing"):
            entry_point(frame(spark, [(0, .4), (1, bad)])).collect()


def test_threshold_metrics_do_not_shuffle_by_score(spark):
    df = frame(spark, [(0, .4), (1, .7), (1, .9)])
    for found in (metrics.confusion_matrix(df), metrics.threshold_metrics(df)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan


def test_empty_table_and_odd_group_names(spark):
    empty = frame(spark, [], "label int, p double")
    row = metrics.classification_metrics(empty).first()
    assert row.roc_auc is None and row.confusion_matrix == [[0, 0], [0, 0]]
    df = frame(spark, [(1, .9, "x"), (0, .1, "x"), (0, .3, None), (1, .2, None)], "label int, p double, `a b` string")
    found = {r["a b"]: r.roc_auc for r in metrics.ranking_metrics(df, ["a b"]).collect()}
    assert found == {"x": 1.0, None: 0.0}


def test_hot_score_and_hot_group(spark):
    rows = [("a", i % 2, 0.25) for i in range(3000)] + [("a", 1, i / 997) for i in range(997)]
    rows += [(f"g{i % 50}", i % 3 == 0, (i % 83) / 83) for i in range(2000)]
    rows = [(g, int(y), p) for g, y, p in rows]
    df = frame(spark, rows, "g string, label int, p double")
    plain = metrics.classification_metrics(df, ["g"]).orderBy("g").collect()
    split = metrics.classification_metrics(df, ["g"], rows_per_task=10).orderBy("g").collect()
    assert plain == split
    assert plain[0].pr_auc == round(slow_average_precision([(y, p) for g, y, p in rows if g == "a"]), 6)


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_by_range_equal_the_plain_window(spark, descending):
    table = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 4).alias("g"),
        F.sin("id").alias("v"), (F.col("id") % 11).alias("m"),
    )
    order = F.desc("v") if descending else F.asc("v")
    window = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    expected = table.withColumn("m_upto", F.sum("m").over(window))
    found = running_totals(table, ["g"], "v", ["m"], descending=descending, rows_per_task=100)
    assert found.columns == expected.columns
    assert found.exceptAll(expected).count() == 0 and found.count() == 5000


def test_running_totals_without_groups(spark):
    table = spark.range(1000).select(F.col("id").alias("v"), F.lit(1).alias("m"))
    found = running_totals(table, [], "v", ["m"], rows_per_task=100)
    assert found.filter("m_upto <> v + 1").count() == 0


def test_slices(spark):
    rows = [(1, 0, .1), (1, 1, .8), (2, 0, .2), (2, 1, .9)]
    report = slices.slice_performance(frame(spark, rows, "sex int, label int, p double"), ["sex", "absent"]).collect()
    assert [r.value for r in report] == ["1", "2"]
    assert all(r.pr_auc == 1.0 for r in report)
    assert [r.predicted_default_rate for r in report] == [.45, .55]


def test_slices_order_as_text_keep_missing_and_single_class(spark):
    rows = [(2, 0, .1), (2, 1, .8), (10, 1, .2), (None, 0, .3)]
    report = slices.slice_performance(frame(spark, rows, "g int, label int, p double"), ["g"]).collect()
    assert [(r.value, r.pr_auc) for r in report] == [("10", None), ("2", 1.0), ("nan", None)]
    nan = [(float("nan"), 0, .1), (None, 1, .8)]
    report = slices.slice_performance(frame(spark, nan, "g double, label int, p double"), ["g"]).collect()
    assert [(r.value, r.rows) for r in report] == [("nan", 2)]


def test_no_slice_column(spark):
    assert slices.slice_performance(frame(spark, [(0, .1)]), ["sex"]).count() == 0


def model_rows(spark, *rows):
    return spark.createDataFrame(rows, "model string, pr_auc double, brier_score double, recall double")


def test_better_challenger_is_promoted(spark):
    row = governance.promotion_checks(model_rows(spark, ("a", .50, .20, .40), ("b", .56, .15, .35)), "a", "b").first()
    assert row.promote


def test_recall_floor_blocks(spark):
    row = governance.promotion_checks(model_rows(spark, ("a", .50, .20, .40), ("b", .56, .15, .10)), "a", "b").first()
    assert not row.promote and not row.minimum_recall and row.pr_auc_gain and row.calibration


def test_equal_metric_selects_the_first_named(spark):
    rows = model_rows(spark, ("z", .5, .1, .1), ("a", .5, .1, .1))
    assert metrics.select_model(rows, ["z", "a"]).first().selected_model == "z"
    assert metrics.select_model(rows, ["a", "z"]).first().selected_model == "a"


def test_published_invariants_hold(spark, sf):
    """Band, bin and matrix totals agree, as in the published report."""
    from scorewright.operators import bands
    from scorewright.plans.views import item_scores

    scored = item_scores(spark, sf)
    total = bands.scored_summary(scored).first()
    by_band = {r.band: r for r in bands.risk_bands(scored).collect()}
    assert sum(r.clients for r in by_band.values()) == total.scored_rows
    assert sum(r.clients for r in bands.calibration_bins(scored).collect()) == total.scored_rows
    m = metrics.classification_metrics(scored).first()
    (tn, fp), (fn, tp) = m.confusion_matrix
    assert by_band["high"].clients == fp + tp
    assert by_band["high"].observed_default_rate == m.precision
    assert fn + tp == total.observed_defaults
    assert np.isclose(m.recall, tp / (tp + fn), atol=1e-6)
