import pytest
from pyspark.sql import functions as F

from scorewright import config
from scorewright.operators import schema
from scorewright.sources import tables


def test_names_become_snake_case_and_aliases_apply():
    assert schema.normalize_name("default payment next month") == config.TARGET
    assert schema.normalize_name("LIMIT BAL") == "limit_bal"
    assert schema.normalize_name("X1") == "limit_bal"
    assert schema.normalize_name("X23") == "pay_amt6"
    assert schema.normalize_name(" Y ") == config.TARGET
    assert schema.normalize_name("x24") == "x24"
    assert schema.normalize_name("--Order.Priority--") == "order_priority"


def test_binding_drops_id_and_keeps_column_order(spark):
    features = spark.createDataFrame([(1, 1, 10_000), (2, 2, 20_000)], "row_id long, ID int, LIMIT_BAL int")
    target = spark.createDataFrame([(1, 0), (2, 1)], "row_id long, `default payment next month` int")
    result = schema.normalize_dataset(features, target)
    assert result.columns == ["row_id", "limit_bal", config.TARGET]
    assert [r[2] for r in result.orderBy("row_id").collect()] == [0, 1]


def test_missing_values_are_rejected(spark):
    features = spark.createDataFrame([(1, 1.0), (2, None)], "row_id long, LIMIT_BAL double")
    target = spark.createDataFrame([(1, 0), (2, 1)], "row_id long, Y int")
    with pytest.raises(ValueError, match="missing values, by column: {'limit_bal': 1}"):
        schema.normalize_dataset(features, target)


def test_rows_without_a_partner_are_rejected(spark):
    features = spark.createDataFrame([(1, 1.0), (2, 2.0)], "row_id long, a double")
    target = spark.createDataFrame([(1, 0), (3, 1)], "row_id long, y int")
    bound = schema.bind_features_target(features, target)
    assert sorted(map(tuple, bound.collect())) == [(1, 1.0, 0), (2, 2.0, None), (3, None, 1)]
    with pytest.raises(ValueError, match="missing values"):
        schema.normalize_dataset(features, target)


def test_repeated_target_keys_do_not_multiply_rows(spark):
    features = spark.createDataFrame([(1, 1.0)] * 3 + [(2, 1.0)], "row_id long, a double")
    target = spark.createDataFrame([(1, 0)] * 3 + [(2, 1)], "row_id long, y int")
    bound = schema.bind_features_target(features, target)
    assert bound.count() == 4
    assert bound.filter("y is null").count() == 3


def test_duplicate_names_are_rejected(spark):
    df = spark.createDataFrame([(1, 2, 0)], "`Limit Bal` int, x1 int, y int")
    with pytest.raises(ValueError, match="share the names \\['limit_bal'\\]"):
        schema.normalize_columns(df)


@pytest.mark.parametrize("values, ddl, message", [
    ([0, 2], "int", "neither 0 nor 1"),
    ([0.0, 0.7], "double", "neither 0 nor 1"),
    (["0", "yes"], "string", "no numbers"),
    ([0, None], "int", "missing values"),
])
def test_target_domain(spark, values, ddl, message):
    df = spark.createDataFrame([(v,) for v in values], f"{config.TARGET} {ddl}")
    with pytest.raises(ValueError, match=message):
        schema.require_valid(df)


def test_text_targets_are_cast(spark):
    df = spark.createDataFrame([("0",), ("1",), ("1.0",)], f"{config.TARGET} string")
    valid = schema.require_valid(df)
    assert dict(valid.dtypes)[config.TARGET] == "tinyint"
    assert sorted(r[0] for r in valid.collect()) == [0, 1, 1]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), 0), (1.0, 1)], f"a double, {config.TARGET} int")
    report = {r.column: r.nulls for r in schema.validation_report(df).collect()}
    assert report == {"a": 1, config.TARGET: 0}


def test_missing_target_column(spark):
    with pytest.raises(ValueError, match="target"):
        schema.require_valid(spark.createDataFrame([(1,)], "a int"))


def test_features_and_target_split(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 2, 1)], f"row_id long, limit_bal int, {config.TARGET} tinyint")
    features, target = schema.split_features_target(df)
    assert features.columns == ["row_id", "limit_bal"]
    assert [tuple(r) for r in target.orderBy("row_id").collect()] == [(1, 0), (2, 1)]


def test_column_partition_keeps_configured_order():
    numeric, categorical = schema.partition_columns(["pay_0", "age", "sex", "limit_bal"])
    assert numeric == ["age", "limit_bal"]
    assert categorical == ["sex", "pay_0"]


def test_load_renames_generic_columns(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text(f"x1,x2,{config.TARGET}\n10000,2,0\n")
    assert tables.load_dataset(spark, str(path)).columns == ["limit_bal", "sex", config.TARGET]
    again = str(tmp_path / "copy")
    tables.write_csv(tables.load_dataset(spark, str(path)), again)
    assert tables.load_dataset(spark, again).first().limit_bal == 10000


def test_load_of_missing_path_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.load_dataset(spark, str(tmp_path / "nothing.csv"))


def test_load_without_target_fails(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("x1\n1\n")
    with pytest.raises(ValueError, match="target column"):
        tables.load_dataset(spark, str(tmp_path / "rows.csv"), validate=False)


def test_dataset_ddl_reads_without_inference(spark, tmp_path):
    ddl = config.schema_ddl()
    row = ["1"] + ["2"] * 23 + ["0"]
    (tmp_path / "full.csv").write_text("row_id," + ",".join(f"x{i}" for i in range(1, 24)) + ",y\n" + ",".join(row) + "\n")
    df = tables.load_dataset(spark, str(tmp_path / "full.csv"), schema=ddl)
    assert df.columns[0] == "row_id" and df.columns[-1] == config.TARGET
    assert dict(df.dtypes)["sex"] == "int" and dict(df.dtypes)["limit_bal"] == "double"


def test_types_follow_names_not_order(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("Y,X5,extra,LIMIT BAL\n1,30,word,2.5\n")
    df = tables.load_dataset(spark, str(tmp_path / "rows.csv"), schema=config.schema_ddl())
    assert dict(df.dtypes) == {config.TARGET: "tinyint", "age": "int", "extra": "string", "limit_bal": "double"}
    assert df.first().limit_bal == 2.5


def test_ingest_keeps_a_normalized_copy(spark, tmp_path):
    features = spark.createDataFrame([(1, 7, 1.5), (2, 8, 2.5)], "row_id long, id int, x1 double")
    target = spark.createDataFrame([(2, 1), (1, 0)], "row_id long, y int")
    kept = tables.ingest_dataset(features, target, str(tmp_path / "kept"))
    assert [tuple(r) for r in kept.orderBy("row_id").collect()] == [(1, 1.5, 0), (2, 2.5, 1)]


def test_positions_follow_file_and_line_order(spark, tmp_path):
    lines = [f"{i}" for i in range(5000)]
    (tmp_path / "lines").mkdir()
    for part in range(5):
        (tmp_path / "lines" / f"part-{part}.csv").write_text("\n".join(lines[part * 1000: part * 1000 + 100 * (part + 1)]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # many blocks per file
    try:
        source = spark.read.schema("v int").csv(str(tmp_path / "lines"))
        assert source.select("_metadata.file_path", "_metadata.file_block_start").distinct().count() > 5
        rows = tables.with_position(source).orderBy("row_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [int(x) for part in range(5) for x in lines[part * 1000: part * 1000 + 100 * (part + 1)]]
    assert [r.row_id for r in rows] == list(range(len(expected)))
    assert [r.v for r in rows] == expected
