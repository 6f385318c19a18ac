"""Labelled datasets, scored rows and JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import config
from ..operators.running import running_totals
from ..operators.schema import (
    normalize_columns,
    normalize_dataset,
    normalize_name,
    require_columns,
    require_valid,
)
from ..storage import materialize


def load_dataset(
    spark: SparkSession, path: str, *, schema: str | None = None, validate: bool = True
) -> DataFrame:
    """Headed CSV with normalized names.

    ``schema`` is DDL that gives types by normalized name, in any order; the
    header alone is read to match them. Without it types are inferred, which
    reads the whole file once more. ``validate=False`` checks the target's
    presence only.
    """
    reader = strict_csv(spark).option("header", True)
    if schema:
        types = {f.name: f.dataType for f in StructType.fromDDL(schema)}
        fields = [StructField(c, types.get(normalize_name(c), StringType())) for c in reader.csv(path).columns]
        reader = reader.schema(StructType(fields))
    else:
        reader = reader.option("inferSchema", True)
    df = require_columns(normalize_columns(reader.csv(path)), [config.TARGET], "target column")
    return require_valid(df) if validate else df


_CORRUPT, _ROW, _AGAIN = "_corrupt", "_row", "_again"


def load_with_rejects(spark: SparkSession, path: str, schema: str, *, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The good rows of a CSV file, under normalized names, and ``file, line, reason`` of every other line.

    Every line is parsed by itself as a typed value, so files are split as any text; a quoted line break makes
    rejects of its lines. ``schema`` is DDL as in :func:`load_dataset`, or of all columns in order without a
    ``header``. The reason is ``number of fields``, or else ``type of`` the first column whose text is no value
    of its type. Blank lines are left out.
    """
    types = StructType.fromDDL(schema)
    lines = spark.read.text(path, lineSep="\n").select(F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("file"))
    lines = lines.filter("trim(line) <> ''")
    if header:
        known = {f.name: f.dataType for f in types}
        given = spark.read.option("header", True).csv(path).columns
        types = StructType([StructField(c, known.get(c, StringType())) for c in map(normalize_name, given)])
        first = F.from_csv("line", ", ".join(f"`c{i}` string" for i in range(len(given))), {"escape": '"'})
        lines = lines.filter(first != F.struct(*[F.lit(c) for c in given]))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "escape": '"'}
    fields = [(f.name, f.dataType.simpleString()) for f in types]

    def parsed(kinds: list[str]):
        ddl = [f"`{name}` {kind}" for (name, _), kind in zip(fields, kinds)] + [f"`{_CORRUPT}` string"]
        return F.from_csv("line", ", ".join(ddl), options)

    rows = lines.withColumn(_ROW, parsed([kind for _, kind in fields]))
    bad = F.col(f"{_ROW}.{_CORRUPT}").isNotNull()
    reason = F.when(F.col(f"{_AGAIN}.{_CORRUPT}").isNotNull(), "number of fields")
    for name, _ in fields:
        reason = reason.when(F.col(f"{_AGAIN}.`{name}`").isNotNull() & F.col(f"{_ROW}.`{name}`").isNull(), f"type of {name}")
    rejects = rows.filter(bad).withColumn(_AGAIN, parsed(["string"] * len(fields))).select("file", "line", reason.otherwise("unreadable").alias("reason"))
    return rows.filter(~bad).select(*[F.col(f"{_ROW}.`{name}`").alias(name) for name, _ in fields]), rejects


def ingest_dataset(
    features: DataFrame, target: DataFrame, path: str, key: str = config.ROW_ID
) -> DataFrame:
    """Bind, normalize and validate two raw tables, keep the result as CSV, return it as read back."""
    bound = normalize_dataset(features, target, key)
    write_csv(bound, path)
    return read_csv(features.sparkSession, path, bound.schema)


def strict_csv(spark: SparkSession):
    """A CSV reader that fails on a line with too few or too many fields, and on a value of the wrong type in a column that is read."""
    return spark.read.option("mode", "FAILFAST").option("columnPruning", False)


#: How this package's CSV keeps any text: quotes are doubled, outer blanks stay, an empty field is null and a
#: quoted empty one an empty text. Readers must tell these apart by a null text that no field holds.
_KEPT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n"}
_NULL = "\u0001null"


def _texts(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, StringType)]


def write_csv(df: DataFrame, path: str, *, header: bool = True, rows_per_file: int = 0) -> None:
    """Any text is kept, with outer blanks, quotes, backslashes and line breaks; nulls and empty texts stay apart.

    Files with texts cannot be split when they are read, so ``rows_per_file`` should bound them. A table of one
    column writes a null text as a mark of its own (its line would be empty); a text equal to it is refused.
    """
    refused = F.raise_error(F.lit(f"a text is {_NULL!r}, which stands for null")).cast("string")
    df = df.withColumns({c: F.when(F.col(f"`{c}`") == _NULL, refused).otherwise(F.col(f"`{c}`")) for c in _texts(df.schema)})
    writer = df.write.mode("overwrite").options(header=header, maxRecordsPerFile=rows_per_file, **_KEPT)
    (writer.option("nullValue", _NULL) if len(df.columns) == 1 else writer).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, *, header: bool = True) -> DataFrame:
    """What :func:`write_csv` wrote, unchanged; fails like :func:`strict_csv`."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = strict_csv(spark).schema(schema).options(header=header, nullValue=_NULL, emptyValue="", **_KEPT)
    return reader.option("multiLine", bool(_texts(schema))).csv(path)


def write_scored(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON document per row."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def with_position(df: DataFrame, name: str = config.ROW_ID) -> DataFrame:
    """Number the rows of a file source in file and line order, for files that carry no key.

    ``df`` must come straight from ``spark.read``. The rows of a file block
    follow each other in one task, so counting the blocks gives every row its
    place. The blocks are written out with the rows: a later read could split
    the files in another way.
    """
    block = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    rows = materialize(df.select("*", *block, F.monotonically_increasing_id().alias("_seq")))
    blocks = rows.groupBy(F.struct("_file", "_start").alias("_at")).agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    offsets = running_totals(blocks, [], "_at", ["_n"]).select(  # one row per file block
        "_at._file", "_at._start", "_first", (F.col("_n_upto") - F.col("_n")).alias("_before")
    )
    position = F.col("_seq") - F.col("_first") + F.col("_before")
    return rows.join(offsets, ["_file", "_start"]).select(*df.columns, position.alias(name))
