"""Arrow batches in tasks: bounded slices of texts, and results of a stated schema."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Characters that a task works on at once; a longer text is a slice of its own.
SLICE = 1 << 19


def text_slices(batch: pa.RecordBatch, column: str = "text", budget: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive rows of about ``budget`` characters with their texts; null texts are empty."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for end, n in enumerate(sizes):
        if held and held + n > budget:
            yield _slice(batch, column, start, end)
            start, held = end, 0
        held += n
    if start < batch.num_rows:
        yield _slice(batch, column, start, batch.num_rows)


def _slice(batch: pa.RecordBatch, column: str, start: int, end: int) -> tuple[pa.RecordBatch, list[str]]:
    part = batch.slice(start, end - start)
    return part, [t or "" for t in part.column(column).to_pylist()]


#: Bytes of an Arrow batch that reaches a task, in sessions that do not set it themselves.
BATCH = 4 << 20
_BATCH_BYTES, _SPARK_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; they need no shared Python path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="scorewright-code-"), "scorewright.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def _give_back() -> None:
    """Return freed pages to the system: a worker is kept for later tasks and would hold on to them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` whose function yields columns by name, cast to ``schema`` (DDL)."""
    ship(df.sparkSession)
    if df.sparkSession.conf.get(_BATCH_BYTES) == _SPARK_BATCH_BYTES:
        df.sparkSession.conf.set(_BATCH_BYTES, str(BATCH))
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            arrays = [pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], (pa.Array, pa.ChunkedArray)) else columns[f.name].cast(f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
            del columns, arrays
            _give_back()
        _give_back()

    return df.mapInArrow(run, struct)
