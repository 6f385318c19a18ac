"""A bitmap of fixed size that says which keys may be wanted, sent to all tasks before a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches

#: Bits of a bitmap: its size never depends on the data, only the share of needless rows it lets pass.
BITS = 1 << 23


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """The bytes of a bitmap in which every value of a column of longs is marked (others may be too)."""
    bit = F.pmod(F.col(column), F.lit(BITS))
    words = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).toArrow()
    marks = np.zeros(BITS // 32, np.uint32)
    marks[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return marks.astype("<u4").view(np.uint8)


def marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % BITS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def split(df: DataFrame, bits: np.ndarray, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``column`` (a long, not null) is marked in ``bits``, and the others."""

    def half(wanted: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                kept = batch.filter(pa.array(marked(bits, batch.column(column).to_numpy()) == wanted))
                yield {c: kept.column(c) for c in kept.schema.names}

        return work

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return map_batches(df, half(True), schema), map_batches(df, half(False), schema)


def without(documents: DataFrame, removed: DataFrame, repeated: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose key (a long) is not in ``removed``; of equal rows of a key in ``repeated`` one stays.

    Only rows that a bitmap of these keys marks are shuffled. Rows without a key stay.
    """
    bits = bitmap(removed.unionByName(repeated).where(F.col(key).isNotNull()), key)
    named = documents.where(F.col(key).isNotNull())
    touched, others = split(named, bits, key)
    touched = touched.join(removed, key, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
    return touched.dropDuplicates([key, "text"]).unionByName(others).unionByName(documents.where(F.col(key).isNull()))
