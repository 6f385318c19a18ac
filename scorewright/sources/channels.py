"""Headerless CSV channels of a three-way split, their manifest, and batch scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators.sampling import stratified_split, three_way
from .digests import file_digests
from .tables import read_csv, write_csv

LABELED = ("train", "validation")
HELD_OUT = "transform"
TEST_LABELS = "test_labels"

# Part files are digested one at a time, as one value of at most 2 GB: they are kept far below that, at so many
# bytes for a field. Channels hold numbers and short codes.
_FILE_BYTES, _FIELD_BYTES = 256 << 20, 64


def rows_per_file(fields: int) -> int:
    return max(1, _FILE_BYTES // (_FIELD_BYTES * max(1, fields)))


def channel_split(df: DataFrame, label: str = "label", key: str = config.ROW_ID, seed: int = config.SEED) -> DataFrame:
    """70/15/15 with a ``split`` column: train, validation, transform."""
    return stratified_split(df, three_way, key=key, label=label, seed=seed)


def write_channels(
    split: DataFrame,
    folder: str,
    features: Sequence[str],
    label: str = "label",
    key: str = config.ROW_ID,
) -> None:
    """Train and validation: label first. The held-out part: features and labels apart.

    The two held-out files start with the row's key. Line order means nothing
    across part files, so they are joined on it.
    """
    def write(part: str, columns: Sequence[str], channel: str) -> None:
        rows = split.filter(F.col("split") == part).select(*columns)
        write_csv(rows, f"{folder}/{channel}", header=False, rows_per_file=rows_per_file(len(columns)))

    for name in LABELED:
        write(name, [label, *features], name)
    write(HELD_OUT, [key, *features], HELD_OUT)
    write(HELD_OUT, [key, label], TEST_LABELS)


def read_headerless(spark: SparkSession, path: str, schema) -> DataFrame:
    """Fails on values of the wrong type and on lines with too few or too many fields."""
    return read_csv(spark, path, schema, header=False)


def labeled_channel(spark: SparkSession, folder: str, name: str, features: str, label: str = "label") -> DataFrame:
    """``features`` is DDL, in the order they were written."""
    return read_headerless(spark, f"{folder}/{name}", f"{label} int, {features}")


def held_out_channel(spark: SparkSession, folder: str, features: str, key: str = config.ROW_ID) -> DataFrame:
    return read_headerless(spark, f"{folder}/{HELD_OUT}", f"{key} bigint, {features}")


def test_labels(spark: SparkSession, folder: str, label: str = "label", key: str = config.ROW_ID) -> DataFrame:
    return read_headerless(spark, f"{folder}/{TEST_LABELS}", f"{key} bigint, {label} int")


def channel_rows(split: DataFrame, label: str = "label") -> DataFrame:
    """Rows and base rate per channel."""
    return split.groupBy(F.col("split").alias("channel")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(label), 6).alias("default_rate")
    )


def manifest(spark: SparkSession, split: DataFrame, folder: str, features: Sequence[str], label: str = "label") -> DataFrame:
    """One row per file: its channel's rows and rate, the feature list, length and digest."""
    digests = file_digests(spark, folder).withColumn("channel", F.element_at(F.split("file", "/"), 1))
    digests = digests.filter(F.col("file").rlike("part-[^/]*$"))
    rows = channel_rows(split, label)
    labels_too = rows.filter(F.col("channel") == HELD_OUT).withColumn("channel", F.lit(TEST_LABELS))
    return digests.join(rows.union(labels_too), "channel").select(
        "channel", "rows", "default_rate",
        F.array(*[F.lit(c) for c in features]).alias("feature_columns"),
        F.lit(len(features)).alias("feature_count"),
        "file", "length", "sha256",
    )


def align_scores(
    labels: DataFrame, scores: DataFrame, label: str = "label", p: str = "p", key: str = config.ROW_ID
) -> DataFrame:
    """Labels and scores of the same keys, one row each.

    Grouping instead of joining: a repeated key folds before the shuffle and
    cannot multiply rows. Reading the result fails unless both sides hold the
    same keys once.
    """
    nothing = F.lit(None)
    both = labels.select(key, F.col(label).cast("int").alias(label), nothing.cast("double").alias(p)).union(
        scores.select(key, nothing.cast("int").alias(label), F.col(p).cast("double").alias(p))
    )
    matched = f"count({label}) = 1 and count({p}) = 1"
    fault = f"raise_error(concat('{key} ', {key}, ' has ', count({label}), ' labels and ', count({p}), ' scores'))"
    return both.groupBy(key).agg(
        *[F.expr(f"if({matched}, max({c}), {fault})").alias(c) for c in (label, p)]
    )
