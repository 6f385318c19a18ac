import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from scorewright import storage
from scorewright.operators import running, sampling
from scorewright.sources import channels, tables


def session(master, configured=None, already=None):
    state = {"dir": already}
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda d: state.update(dir=d),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured))


def test_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(session("yarn"))


def test_configured_folder_is_used():
    assert storage.shared_folder(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert storage.shared_folder(session("yarn", None, "hdfs:///set")) == "hdfs:///set"


def test_local_master_falls_back_to_a_new_folder():
    assert "scorewright-" in storage.shared_folder(session("local[2]"))


def test_materialized_table_keeps_rows_and_types(spark):
    df = spark.range(10).select("id", F.struct(F.col("id").alias("a"), F.lit(True).alias("b")).alias("s"), F.lit("x y").alias("a b"))
    kept, seen = storage.materialize_checked(df, odd="count_if(id % 2 = 1)")
    assert seen == {"rows": 10, "odd": 5}
    assert kept.dtypes == df.dtypes and kept.exceptAll(df).count() == 0
    assert storage.scratch_path(spark, "t") != storage.scratch_path(spark, "t")


def test_small_table_types(spark):
    table = storage.small_table(spark, a=["x"], b=[[1.0, 2.0]], c=[None])
    assert table.dtypes == [("a", "string"), ("b", "array<double>"), ("c", "double")]


def test_discarded_tables_are_gone(spark):
    kept, gone = (storage.materialize(spark.range(3)) for _ in range(2))
    parts = storage.materialize(spark.range(6).withColumn("k", F.col("id") % 2), partition_by="k")
    assert parts.filter("k = 1").count() == 3
    files = gone.inputFiles() + parts.inputFiles()
    storage.discard(gone, parts)
    assert kept.count() == 3 and not any(os.path.exists(f.removeprefix("file://")) for f in files)


@pytest.mark.parametrize("line", ["0,abc", "1,0.7,9", "1"])
def test_bad_lines_are_refused(spark, tmp_path, line):
    (tmp_path / "part-0.csv").write_text(f"0,0.5\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed|FAILED_READ"):
        channels.read_headerless(spark, str(tmp_path), "row_id int, p double").collect()


TEXTS = [None, "", " ", " lead", "trail ", '"q"', 'a"b', '"', "a,b", "a\\b", "\\", '\\"', "a\nb", "a\r\nb", "\r", "\n\n", "#x", "\t", "null", "\\N", "é🙂", "x\x00y", "'", ' "x" ', "\u2028"]


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("columns", [["i", "t"], ["t", "i"], ["t"]])
def test_csv_keeps_any_text(spark, tmp_path, header, columns):
    rows = [(i if i % 4 else None, t, str(i)) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "i int, t string, u string").select(*columns).repartition(3)
    tables.write_csv(df, str(tmp_path / "out"), header=header, rows_per_file=4)
    found = tables.read_csv(spark, str(tmp_path / "out"), df.schema, header=header)
    assert found.exceptAll(df).isEmpty() and df.exceptAll(found).isEmpty()


def test_the_mark_of_null_is_no_text(spark, tmp_path):
    with pytest.raises(Exception, match="stands for null"):
        tables.write_csv(spark.createDataFrame([("\x01null",)], "t string"), str(tmp_path / "out"))


def test_channels_keep_texts(spark, tmp_path):
    split = spark.createDataFrame([(i, i % 2, t, part) for part in (*channels.LABELED, channels.HELD_OUT) for i, t in enumerate(TEXTS)], "row_id long, label int, t string, split string")
    channels.write_channels(split, str(tmp_path), ["t"])
    for name in channels.LABELED:
        found = channels.labeled_channel(spark, str(tmp_path), name, "t string")
        assert sorted(map(repr, (r.t for r in found.collect()))) == sorted(map(repr, TEXTS))
    held = {r.row_id: r.t for r in channels.held_out_channel(spark, str(tmp_path), "t string").collect()}
    assert held == dict(enumerate(TEXTS))


def test_rejected_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Row ID,X1,Name,Y\n1,2.5,"a, b",0\n2,much,c,1\n3,1,d\n4,1,d,1,9\n5,,,0\n6,1,"say ""x""",yes\n')
    (tmp_path / "b.csv").write_text("Row ID,X1,Name,Y\n7,7,e,1\nseven,8,f,1\n")
    ddl = "row_id bigint, limit_bal double, name string, default_next_month int"
    good, rejects = tables.load_with_rejects(spark, str(tmp_path), ddl)
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2.5, "a, b", 0), (5, None, None, 0), (7, 7.0, "e", 1)]
    found = sorted((os.path.basename(r.file), r.line, r.reason) for r in rejects.collect())
    assert found == [
        ("a.csv", "2,much,c,1", "type of limit_bal"), ("a.csv", "3,1,d", "number of fields"), ("a.csv", "4,1,d,1,9", "number of fields"),
        ("a.csv", '6,1,"say ""x""",yes', "type of default_next_month"), ("b.csv", "seven,8,f,1", "type of row_id"),
    ]
    assert good.columns == ["row_id", "limit_bal", "name", "default_next_month"]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        tables.load_dataset(spark, str(tmp_path), schema=ddl)


def scans(spark, work):
    """How often ``work`` reads rows of a counted source."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = 40
    source = spark.range(rows).selectExpr("id as row_id", "cast(id % 2 as int) as label", "id * 1.5D as x").mapInArrow(count, "row_id long, label int, x double")
    work(source)
    return read.value / rows


def test_checks_need_no_scan_of_their_own(spark, tmp_path):
    features, target = (lambda df: df.selectExpr("row_id", "x as x1")), (lambda df: df.selectExpr("row_id", "label as y"))
    ingest = scans(spark, lambda df: tables.ingest_dataset(features(df), target(spark.range(40).selectExpr("id as row_id", "cast(id % 2 as int) as label")), str(tmp_path / "a")).count())
    assert ingest == 1
    assert scans(spark, lambda df: sampling.seeded_donors(df, ["x"]).count()) == 1
    assert scans(spark, lambda df: running.running_totals(df, [], "row_id", ["label"]).count()) == 1


def test_invalid_tables_leave_nothing(spark, tmp_path):
    features = spark.createDataFrame([(1, 2.0), (2, None)], "row_id long, x1 double")
    target = spark.createDataFrame([(1, 0), (2, 1)], "row_id long, y int")
    before = set(os.listdir(storage.shared_folder(spark).removeprefix("file:")))
    with pytest.raises(ValueError, match="missing values"):
        tables.ingest_dataset(features, target, str(tmp_path / "a"))
    assert set(os.listdir(storage.shared_folder(spark).removeprefix("file:"))) == before and not (tmp_path / "a").exists()
