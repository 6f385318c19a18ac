"""Token counts of whole texts; very long ones by overlap resynchronisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.pieces import byte_tokenizer
from scorewright.llm.resync import CHUNK, spliced_ids


def token_counts(documents: DataFrame, vocabulary: str, *, limit: int = 1024, chunk: int = CHUNK, key: str = "doc_id") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row of ``documents``.

    ``vocabulary`` is a byte-level BPE file of the tokenizers library, readable on every executor. Texts of
    over ``chunk`` characters are encoded in overlapping chunks. There is no shuffle; a task holds one slice
    of texts. A null or empty text has 0 bytes and tokens; null keys and repeated rows are kept, one result
    per row; an empty table gives no rows; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokenizer = byte_tokenizer(vocabulary)
        for batch in batches:
            for part, texts in text_slices(batch):
                long = [i for i, t in enumerate(texts) if len(t) > chunk]
                counts = tokenizer.counts(["" if len(t) > chunk else t for t in texts])
                for i in long:
                    counts[i] = sum(map(len, spliced_ids(tokenizer, texts[i], chunk)))
                yield {key: part.column(key), "n_bytes": part.column("n_bytes"), "n_tokens": counts, "over_limit": np.asarray(counts > limit)}

    kind = documents.schema[key].dataType.simpleString()
    taken = documents.select(key, "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return map_batches(taken, work, f"{key} {kind}, n_bytes long, n_tokens long, over_limit boolean")
