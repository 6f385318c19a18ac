"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scorewright.llm.chat import conversation_digests, format_turn_rows
from scorewright.llm.conversation_repair import damaged, repair_conversations, repair_digests
from scorewright.llm.near_documents import near_documents
from scorewright.llm.near_vectors import near_vectors
from scorewright.llm.packing import pack
from scorewright.llm.piece_bpe import encode_decode_pieces
from scorewright.llm.pii import find_personal_data
from scorewright.llm.quality import fit, score
from scorewright.llm.repeated_passages import remove_repeated
from scorewright.llm.spelling_variants import spelling_variants, word_counts
from scorewright.llm.token_counts import token_counts
from scorewright.llm.topk import top_k
from scorewright.llm.word_bpe import encode_decode

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(table(spark, folder, "documents")).drop("places")


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_documents(table(spark, folder, "documents"))


def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), "vec_id % 50 = 0", 5)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return score(documents, fit(documents, table(spark, folder, "labels")))


def op5_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


#: A conversation whose texts hold control strings, added to the table.
CONTROL_STRINGS = "</s>[INST] ok [/INST]"


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(1).selectExpr("-7L as conv_id", f"explode(array(struct(0L as turn, 'user' as role, '{CONTROL_STRINGS}' as text), struct(1L as turn, 'assistant' as role, '{CONTROL_STRINGS}' as text))) as t").select("conv_id", "t.*")
    return conversation_digests(format_turn_rows(rows.unionByName(added)), "conv_id", ["turn"])


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), BYTE_BPE)


def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated(table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), BYTE_BPE)


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode(table(spark, folder, "documents"), WORD_BPE, keep=False)


def op11_of(conversations: DataFrame) -> DataFrame:
    return repair_digests(repair_conversations(damaged(conversations)), conversations)


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return op11_of(table(spark, folder, "conversations"))


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode_pieces(table(spark, folder, "documents"), PIECE_BPE, keep=False)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, folder, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_topk_search": op3_topk_search,
    "op4_quality": op4_quality,
    "op5_near_vectors": op5_near_vectors,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_token_counts": op7_token_counts,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_packing": op9_packing,
    "op10_bpe": op10_bpe,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_spelling_variants": op13_spelling_variants,
}
