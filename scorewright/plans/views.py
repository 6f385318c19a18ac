"""Scored tables derived from the order and document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("row_id")).agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sum("l_quantity").alias("qty"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
            F.sum(F.round(F.col("l_discount") * 100).cast("int")).alias("dc"),
        )
    )


def _score(base: float, per_item: float):
    raw = F.lit(base) - F.lit(per_item) * F.col("n_items") + F.lit(0.009) * F.col("dc") / F.col("n_items")
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)), 6)


def item_scores(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order that has items: label, score ``p`` and a rival score ``p_rival``."""
    return _items(spark, folder).select(
        "row_id", (2 * F.col("n_returned") > F.col("n_items")).cast("int").alias("label"),
        "n_items", "qty", "n_returned", "dc",
        _score(0.7, 0.12).alias("p"), _score(0.45, 0.05).alias("p_rival"),
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumnRenamed("o_orderkey", "row_id")


def orders_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Scores with order and customer attributes. Columns a query drops are never read."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    sample = F.when(F.year("o_orderdate") < 1998, "reference").otherwise("current")
    return (
        _orders(spark, folder)
        .join(item_scores(spark, folder), "row_id")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("sample", sample)
        .drop("o_custkey", "c_custkey", "o_orderdate")
    )


def orders_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """All orders; those without items miss ``n_items``, ``qty`` and ``size``."""
    size = F.when(F.col("n_items") >= 6, "large").when(F.col("n_items") >= 3, "medium").otherwise("small")
    items = _items(spark, folder).withColumn("size", size)
    return _orders(spark, folder).join(items, "row_id", "left").select(
        "row_id", "o_totalprice", "o_orderstatus", "o_orderpriority", "n_items", "qty", "n_returned", "size"
    )


def docs_labeled(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents, scored by length. ``text`` is not read."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    length = F.col("n_chars").cast("double")
    return (
        table(spark, folder, "labels").join(documents, "doc_id")
        .select(
            F.col("doc_id").alias("row_id"), F.col("quality").alias("label"), "toxic",
            "lang", "source", "n_chars",
            F.round(length / (length + F.lit(1000.0)), 6).alias("p"),
        )
    )
