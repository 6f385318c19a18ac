"""Shared-folder handling: scratch tables and cut lineage.

Everything goes below the folder the cluster names in ``spark.checkpoint.dir``.
A machine-local folder is used only for a local master that names none.
"""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="scorewright-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Compute ``df`` once, as a columnar table in the shared folder.

    Later reads prune columns, start from its files and survive lost executors.
    With ``partition_by`` a filter on that column reads its files only.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Shuffle partitions that one task of :func:`materialize_shuffled` writes as one file, and tasks for each core at least.
TOGETHER, TASKS = 8, 12


def materialize_shuffled(df: DataFrame) -> DataFrame:
    """:func:`materialize` for a table that comes out of a shuffle, with several partitions to a file.

    A task takes its partitions one after the other, each as it would alone, so it needs no more memory. Small tables
    do not become a file for each shuffle partition: Hadoop's local file system starts two processes for every file,
    and for a moment each counts as a second executor.
    """
    spark = df.sparkSession
    tasks = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // TOGETHER)
    return materialize(df.coalesce(max(TASKS * spark.sparkContext.defaultParallelism, tasks)))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this package."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that no later read needs, here or in a result that is still to be computed."""
    for df in tables:
        for path in {re.match(".*/table-[0-9a-f]{32}(?=/)", path)[0] for path in df.inputFiles()}:
            delete(df.sparkSession, path)


def materialize_checked(df: DataFrame, **checks: str | Column) -> tuple[DataFrame, dict[str, int]]:
    """:func:`materialize`, with its ``rows`` and further aggregates (SQL or columns) of what was written.

    ``df`` is computed once. Rows are counted from file footers, and checks read only their own columns.
    (``DataFrame.observe`` would save that, but a session that has observed anything cannot be sent to tasks
    any more, and a logistic model that was just fitted sends its session along.)
    """
    done = materialize(df)
    aggregates = {"rows": F.count(F.lit(1))} | {name: F.expr(e) if isinstance(e, str) else e for name, e in checks.items()}
    return done, done.agg(*[e.alias(name) for name, e in aggregates.items()]).first().asDict()


def pin(df: DataFrame) -> DataFrame:
    """Compute a table of report size once and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_table(spark: SparkSession, **columns: list) -> DataFrame:
    """A local relation of a few driver-side rows: joining it needs no job.

    A column without any value is double.
    """
    arrays = {name: pa.array(values) for name, values in columns.items()}
    typed = {
        name: array.cast(pa.float64()) if pa.types.is_null(array.type) else array
        for name, array in arrays.items()
    }
    return spark.createDataFrame(pa.table(typed))
