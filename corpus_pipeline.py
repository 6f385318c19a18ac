"""From raw documents to packed training sequences, in five stages that each read what the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns the columns of ``documents`` (the last one: pieces). Other
columns than ``doc_id`` and ``text`` travel in one struct, so their names cannot clash with an operator's.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.filters import without
from scorewright.llm.near_documents import near_documents
from scorewright.llm.packing import pack
from scorewright.llm.pii import redact
from scorewright.llm.quality import fit, score
from scorewright.llm.repeated_passages import remove_repeated
from scorewright.storage import materialize, materialize_shuffled

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _folded(docs: DataFrame) -> DataFrame:
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(True).alias("doc_id"), *others).alias("others"))


def _unfolded(folded: DataFrame, docs: DataFrame, text: Column, changed: bool = True) -> DataFrame:
    """The columns of ``docs`` with a new text; ``n_chars`` follows it if it is ``changed``."""
    new = {"doc_id": F.col("doc_id"), "text": text}
    if changed:
        new["n_chars"] = F.coalesce(F.length(text), F.lit(0))
    kinds = dict(docs.dtypes)
    return folded.select(*[(new[c].cast(kinds[c]) if c in new else F.col(f"others.`{c}`")).alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on ``labels``, does not reject.

    A null text is scored as an empty one; rows without an id and repeated rows are scored like others, each by
    itself; an empty table stays empty.
    """
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = score(_folded(docs), model, carry=("text", "others")).where("predicted = 1")
    return _unfolded(kept, docs, F.col("text"), changed=False)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; rows without an id stay.

    Rows of one id with different texts are documents of their own; of equal rows one stays.
    """
    own = "own"
    while own in docs.columns:
        own += "_"
    groups = materialize_shuffled(near_documents(docs, rows_of=True)).where("doc_id is not null")
    removed = groups.where("own <> first").select(F.col("own").alias(own))
    repeated = groups.groupBy(F.col("own").alias(own)).agg(F.count("*").alias("n")).where("n > 1").select(own)
    named = docs.withColumn(own, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    return without(named, removed, repeated, own).drop(own)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur elsewhere too.

    Every row stays, with or without an id; null texts stay null; of repeated rows all lose what they share; an
    empty table stays empty.
    """
    removed = remove_repeated(_folded(docs), carry=("text", "others"), digest=False)
    return _unfolded(removed, docs, F.when(F.col("text").isNotNull(), F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data and every credential replaced by its kind.

    Every row stays, with or without an id, repeated ones too; null texts stay null; an empty table stays empty.
    """
    return _unfolded(_folded(redact(docs)), docs, F.col("text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that the documents are packed into.

    A null text is a document of its end id alone; rows without an id and repeated rows are packed like others;
    an empty table gives no pieces.
    """
    return pack(docs, VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each_group),
    ("repeated_passages", drop_repeated_passages),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Fitted trees, bootstrapped patterns and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the kept documents are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
