"""Blocks of vectors: rows packed so that two blocks meet in one task as two matrices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scorewright.llm.batches import ship


def finite(column: str) -> Column:
    """True for vectors that hold something, and only finite numbers."""
    number = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))) & ~F.isnan(x.cast("double"))
    return F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(column, number)


def matrix(batch: pa.Table, column: str) -> np.ndarray:
    """The vectors of a column, all of one length, as doubles."""
    flat = batch.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(batch.num_rows, -1)


def per_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], dict], schema: str) -> DataFrame:
    """``applyInArrow`` on groups of bounded size, returning columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(table: pa.Table) -> pa.Table:
        columns = work(table)
        return pa.Table.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.groupBy(*keys).applyInArrow(run, struct)


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dictionaries, each converted only when it is reached."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}
