import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.operators import permutation, sampling, schema
from scorewright.sources import channels


def test_allocation_follows_the_published_split():
    parts = sampling.two_way({0: 23364, 1: 6636})
    assert parts["test"] == {0: 4673, 1: 1327}


def test_three_way_sizes():
    parts = sampling.three_way({0: 20, 1: 20})
    assert {k: sum(v.values()) for k, v in parts.items()} == {"train": 28, "validation": 6, "transform": 6}


@pytest.mark.parametrize("n, positives", [(1000, 171), (40, 20), (7, 3), (5, 1)])
def test_split_is_exact_disjoint_and_complete(spark, n, positives):
    df = spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") < positives).cast("int").alias("label"))
    for sizes in (sampling.two_way, sampling.three_way):
        split = sampling.stratified_split(df, sizes).collect()
        assert sorted(r.row_id for r in split) == list(range(n))
        wanted = {
            (name, c): k for name, part in sizes({0: n - positives, 1: positives}).items()
            for c, k in part.items() if k
        }
        found = {}
        for r in split:
            found[r.split, r.label] = found.get((r.split, r.label), 0) + 1
        assert found == wanted


def test_split_depends_on_the_seed_only(spark):
    df = spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    first = set(sampling.stratified_split(df).filter("split = 'test'").collect())
    again = set(sampling.stratified_split(df.repartition(7)).filter("split = 'test'").collect())
    other = set(sampling.stratified_split(df, seed=1).filter("split = 'test'").collect())
    assert first == again and first != other


def test_text_keys(spark):
    df = spark.range(100).select(F.concat(F.lit("k'"), "id").alias("row_id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    assert sampling.stratified_split(df).filter("split = 'test'").count() == 20


@pytest.mark.parametrize("repeated", ["1L", "if(id = 0, 999L, id)", "if(id = 500, 17L, id)"])
def test_a_repeated_key_anywhere_is_rejected(spark, repeated):
    df = spark.range(1000).selectExpr(f"{repeated} as row_id", "cast(id % 2 as int) as label")
    with pytest.raises(ValueError, match="row_id is not unique"):
        sampling.stratified_split(df)


def test_unique_keys_fold_before_they_meet(spark):
    schema.require_unique(spark.range(1000).toDF("k"), "k")
    with pytest.raises(ValueError, match="k is not unique"):
        schema.require_unique(spark.createDataFrame([(None,), (1,), (None,)], "k int"), "k")


@pytest.mark.parametrize("rows_per_task", [10**6, 150])
def test_donors_are_a_permutation(spark, rows_per_task):
    df = spark.range(2000).select(F.col("id").alias("row_id"), F.col("id").alias("x"))
    rows = sampling.seeded_donors(df, ["x"], rows_per_task=rows_per_task).collect()
    for repeat in (1, 2):
        donated = [r.donor.x for r in rows if r.repeat == repeat]
        assert sorted(donated) == list(range(2000))
        assert all(r.donor.x != r.row_id for r in rows)
    first = {r.row_id: r.donor.x for r in rows if r.repeat == 1}
    second = {r.row_id: r.donor.x for r in rows if r.repeat == 2}
    assert first != second
    correlation = np.corrcoef(list(first), list(first.values()))[0, 1]
    assert abs(correlation) < 0.1


def test_a_new_row_changes_one_donor(spark):
    def donors(n):
        df = spark.range(n).select(F.col("id").alias("row_id"), F.col("id").alias("x"))
        found = sampling.seeded_donors(df, ["x"], repeats=1, rows_per_task=10_000)
        return {r.row_id: r.x for r in found.select("row_id", "donor.x").collect()}

    before, after = donors(50_000), donors(50_001)
    changed = [k for k in before if before[k] != after[k]]
    assert len(changed) == 1 and after[changed[0]] == 50_000


def test_columns_may_be_shuffled_on_their_own(spark):
    df = spark.range(300).select(F.col("id").alias("row_id"), F.col("id").alias("x"), F.col("id").alias("y"))
    rows = sampling.seeded_donors(df, ["x", "y"], repeats=1, per_column=True).collect()
    by_x = {r.row_id: r.donor.x for r in rows if r.shuffled == "x"}
    by_y = {r.row_id: r.donor.y for r in rows if r.shuffled == "y"}
    assert sorted(by_x.values()) == sorted(by_y.values()) == list(range(300)) and by_x != by_y


def test_missing_values_are_donated_too(spark):
    df = spark.range(50).select(F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"))
    rows = sampling.seeded_donors(df, ["x"], repeats=1).collect()
    assert sum(r.donor.x is None for r in rows) == 25


@pytest.mark.parametrize("label", ["cast(null as int)", "2", "cast(id as int)"])
def test_split_refuses_other_labels_than_classes(spark, label):
    df = spark.range(30).selectExpr("id as row_id", f"{label} as label")
    with pytest.raises(ValueError, match="0 or 1"):
        sampling.stratified_split(df)


def test_large_cells_of_a_cut_are_divided(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("row_id"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    wanted = set(sampling.stratified_split(df).filter("split = 'test'").collect())
    monkeypatch.setattr(sampling, "_CELL_DIGITS", 1)
    monkeypatch.setattr(sampling, "_ROWS_PER_CELL", 3)
    assert set(sampling.stratified_split(df).filter("split = 'test'").collect()) == wanted


def test_importance_of_used_and_unused_columns(spark):
    df = spark.range(400).select(
        F.col("id").alias("row_id"), (F.col("id") % 4 == 0).cast("int").alias("label"),
        ((F.col("id") % 4 == 0).cast("double") * 0.6 + F.rand(3) * 0.4).alias("signal"),
        F.rand(5).alias("noise"),
    )
    found = permutation.permutation_importance(df, lambda t: t.withColumn("p", F.col("signal")), ["noise", "signal"])
    top = permutation.top_features(found).collect()
    assert [r.feature for r in top] == ["signal", "noise"]
    assert top[0].importance > 0.4 and top[1].importance == 0.0
    assert permutation.top_features(found, 1).count() == 1
    alone = permutation.permutation_importance(
        df, lambda t: t.withColumn("p", F.col("signal")), ["noise", "signal"], per_column=True
    )
    assert [r.importance > 0.4 for r in permutation.top_features(alone).collect()] == [True, False]


def test_channels(spark, tmp_path):
    rows = 40
    df = spark.range(rows).select(
        F.col("id").alias("row_id"), (F.col("id") + 1).alias("limit_bal"), (F.col("id") + 20).alias("age"),
        (F.col("id") % 2).cast("int").alias("label"),
    )
    split = channels.channel_split(df)
    folder = str(tmp_path)
    channels.write_channels(split, folder, ["limit_bal", "age"])
    lines = [line for f in (tmp_path / "train").glob("part-*") for line in f.read_text().splitlines()]
    assert len(lines) == 28
    assert all(line.split(",")[0] in {"0", "1"} and len(line.split(",")) == 3 for line in lines)
    found = channels.manifest(spark, split, folder, ["limit_bal", "age"]).collect()
    assert {r.channel for r in found} == {"train", "validation", "transform", "test_labels"}
    assert all(r.feature_count == 2 and len(r.sha256) == 64 for r in found)
    per_channel = {r.channel: (r.rows, r.default_rate) for r in found}
    assert sum(per_channel[c][0] for c in ("train", "validation", "transform")) == rows
    assert per_channel["train"] == (28, 0.5)


def test_scores_and_labels_must_have_the_same_keys(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "row_id long, label int")
    good = spark.createDataFrame([(3, .9), (1, .1), (2, .8)], "row_id long, p double")
    assert sorted(map(tuple, channels.align_scores(labels, good).collect())) == [(1, 0, .1), (2, 1, .8), (3, 1, .9)]
    for bad in ([(1, .1), (2, .8)], [(1, .1), (2, .8), (3, .9), (4, .9)], [(1, .1), (2, .8), (3, .9), (3, .9)]):
        with pytest.raises(Exception, match="labels and"):
            channels.align_scores(labels, spark.createDataFrame(bad, "row_id long, p double")).collect()
