import hashlib
import json

import pytest
from pyspark.sql import functions as F

from scorewright import config
from scorewright.functions import calibration_bin, calibration_label, decision, risk_band, unit_edges, utc_stamp
from scorewright.operators import bands
from scorewright.plans import report
from scorewright.sources import digests, registry, tables


def scored(spark, rows):
    return spark.createDataFrame(rows, "actual_default int, default_probability double, predicted_default int")


def metrics(spark):
    row = ("pr_auc", "b", [("a", .7, .5, .1, .2, .3, .4, [[1, 2], [3, 4]]), ("b", .8, .6, .1, .2, .3, .4, [[5, 6], [7, 8]])])
    return spark.createDataFrame([row], report.METRICS_SCHEMA)


def test_payload(spark):
    rows = [(0, .05, 0), (0, .25, 0), (1, .55, 1), (1, .85, 1)]
    payload = report.report_payload(scored(spark, rows), metrics(spark)).first()
    assert payload.summary.scored_rows == 4 and payload.summary.observed_defaults == 2
    assert payload.summary.selected_model == "b"
    assert [(b.band, b.clients) for b in payload.risk_bands] == [("low", 1), ("review", 1), ("high", 2)]
    assert [b.bin for b in payload.calibration] == ["(-0.001, 0.1]", "(0.2, 0.3]", "(0.5, 0.6]", "(0.8, 0.9]"]
    assert [m.name for m in payload.models] == ["a", "b"]
    assert payload.models[1].confusion_matrix == [[5, 6], [7, 8]]


def test_payload_files(spark, tmp_path):
    tables.write_scored(scored(spark, [(0, .05, 0), (1, .85, 1)]), str(tmp_path / "scored"))
    tables.write_json(metrics(spark), str(tmp_path / "metrics"))
    report.write_report(spark, str(tmp_path / "scored"), str(tmp_path / "metrics"), str(tmp_path / "payload"))
    (part,) = (tmp_path / "payload").glob("part-*.json")
    document = json.loads(part.read_text())
    assert list(document) == ["summary", "models", "risk_bands", "calibration", "disclaimer"]
    assert [b["clients"] for b in document["risk_bands"]] == [1, 0, 1]
    assert document["risk_bands"][1]["observed_default_rate"] == 0.0


def test_missing_prediction_columns(spark):
    with pytest.raises(ValueError, match="actual_default"):
        report.report_payload(spark.createDataFrame([(1.0,)], "default_probability double"), metrics(spark))


def test_bins_and_bands_at_their_edges(spark):
    values = [0.0, .1, .2, .30000000000000004, .3, .5, 1.0, -.1, 1.1, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    rows = df.select("p", calibration_bin("p").alias("bin"), risk_band("p").alias("band"), decision("p").alias("d")).collect()
    assert [r.bin for r in rows] == [1, 1, 2, 3, 3, 5, 10, None, None, None, None]
    assert [r.band for r in rows] == ["low", "low", "review", "review", "review", "high", "high", "low", "high", None, None]
    assert [r.d for r in rows] == [0, 0, 0, 0, 0, 1, 1, 0, 1, 0, None]
    assert unit_edges()[3] == 0.30000000000000004
    assert df.select(calibration_label("10").alias("t")).first().t == "(0.9, 1.0]"


def test_empty_bins_are_left_out(spark):
    df = spark.createDataFrame([(0, .95), (1, .05), (1, .05)], "label int, p double")
    rows = bands.calibration_bins(df).collect()
    assert [(r.bin_index, r.clients, r.observed_default_rate) for r in rows] == [(1, 2, 1.0), (10, 1, 0.0)]


def test_registry_and_run_log(spark, tmp_path):
    artifact = tmp_path / "model.bin"
    artifact.write_bytes(b"deterministic-model")
    found = spark.createDataFrame([("a", .6, .55, [[1, 2], [3, 4]]), ("b", .5, .5, [[0, 0], [0, 0]])],
                                  "model string, roc_auc double, pr_auc double, confusion_matrix array<array<bigint>>")
    for _ in range(2):
        registry.append(registry.registry_entry(found, "a", str(artifact)), str(tmp_path / "registry"))
    entries = spark.read.parquet(str(tmp_path / "registry")).collect()
    assert len(entries) == 2 and entries[0].stage == "candidate"
    assert entries[0].artifact_sha256 == hashlib.sha256(b"deterministic-model").hexdigest()
    assert entries[0].metrics.pr_auc == .55 and len(entries[0].version) == 16
    log = {(r.kind, r.key): r.value for r in registry.run_log(found, "a").collect()}
    assert log == {("param", "selected_model"): "a", ("param", "selection_metric"): "pr_auc",
                   ("metric", "roc_auc"): "0.6", ("metric", "pr_auc"): "0.55"}


def test_folder_digest_depends_on_content_only(spark, tmp_path):
    for name, texts in (("one", ["a", "b", "c"]), ("two", ["c", "a", "b"]), ("three", ["a", "b", "d"])):
        (tmp_path / name).mkdir()
        for i, text in enumerate(texts):
            (tmp_path / name / f"{i}.txt").write_text(text)
    one, two, three = (digests.artifact_digest(spark, str(tmp_path / n)).first().sha256 for n in ("one", "two", "three"))
    assert one == two != three and len(one) == 64
    files = {r.file: r.sha256 for r in digests.file_digests(spark, str(tmp_path / "one")).collect()}
    assert files["0.txt"] == hashlib.sha256(b"a").hexdigest()


def test_stamp_is_utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        ts = F.expr("timestamp'2024-05-01 00:00:00'")
        assert spark.range(1).select(utc_stamp(ts).alias("t")).first().t == "20240430T150000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_policy_defaults():
    assert config.PromotionPolicy() == config.PromotionPolicy(0.005, 0.01, 0.30)
