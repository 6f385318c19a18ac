"""Imputation, scaling and one-hot encoding: as table operators and as a saved ML pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing, known_text, sql_number, sql_text
from ..storage import discard, materialize, scratch_path
from .quantiles import column_quantiles, modes, text_counts
from .running import running_totals


# Categories up to which labels are kept inside a pipeline, and columns that ``one_hot`` may add.
WIDEST_ENCODING = 10_000


@dataclass(frozen=True)
class FillValues:
    """What replaces missing values: one number or text per column."""

    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)


def fit_fill_values(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
    counts: DataFrame | None = None, **options,
) -> FillValues:
    """Exact medians and modes; the driver gets one per column.

    ``counts`` is ``text_counts`` of the categorical columns, if already at hand.
    """
    medians, frequent = {}, {}
    if numeric:
        grid = column_quantiles(df, numeric, 2, **options)
        medians = {c: q.edges[1] for c, q in grid.items() if q.known}
    if categorical:
        counts = text_counts(df, categorical) if counts is None else counts
        frequent = {row.feature: row.mode for row in modes(counts).collect()}
    empty = [c for c in (*numeric, *categorical) if c not in medians and c not in frequent]
    if empty:
        raise ValueError(f"No known value in: {empty}")
    return FillValues(medians, frequent)


def fit_categories(counts: DataFrame, widest: int = WIDEST_ENCODING) -> dict[str, list[str]]:
    """Known texts per column of ``text_counts``, in order. Each becomes a column of the encoding.

    All columns together may have ``widest`` texts: a free text is refused
    before anything reaches the driver (:func:`category_dictionary` takes any).
    """
    width = counts.count()
    if width > widest:
        raise ValueError(f"{width} distinct categories would become columns; at most {widest} are allowed")
    categories: dict[str, list[str]] = {}
    for row in counts.select("feature", "text").collect():
        categories.setdefault(row.feature, []).append(row.text)
    return {c: sorted(found) for c, found in categories.items()}


def impute(df: DataFrame, fill: FillValues) -> DataFrame:
    """Numeric columns become double, categorical ones text, none with missing values."""
    filled: dict[str, Column] = {}
    types = dict(df.dtypes)
    for c, value in fill.medians.items():
        number = F.col(c).cast("double")
        filled[c] = F.when(is_missing(number), F.lit(value)).otherwise(number)
    for c, value in fill.modes.items():
        filled[c] = F.coalesce(F.expr(known_text(c, types[c])), F.lit(value))
    return df.withColumns(filled)


def fit_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column in one aggregation; a constant column gets 1."""
    row = df.agg(
        *[F.avg(c).alias(f"{c}|m") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}|s") for c in columns],
    ).first()
    return {c: (row[f"{c}|m"], row[f"{c}|s"] or 1.0) for c in columns}


def standardize(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scale.items()})


def one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """0/1 columns ``<column>_<value>``; an unknown or missing value has zeros everywhere."""
    types = dict(df.dtypes)
    return df.select(
        "*",
        *[
            F.coalesce((F.expr(known_text(c, types[c])) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
            for c, values in categories.items() for v in values
        ],
    )


def category_dictionary(counts: DataFrame, **options) -> DataFrame:
    """``feature, text, place``: the known texts of ``text_counts``, numbered from 0 in the order of the texts.

    Numbering is a running total over ranges, so a column may have any number of texts; none reaches the driver.
    """
    one = counts.select("feature", "text", F.lit(1).alias("one"))
    return running_totals(one, ["feature"], "text", ["one"], **options).select("feature", "text", (F.col("one_upto") - 1).alias("place"))


def _dictionary_stages(counts: DataFrame, categorical: Sequence[str], path: str, **options) -> list:
    """Stages from ``<c>__text`` to ``<c>__hot`` that join a dictionary stored at ``path`` by value.

    Unknown texts get the place behind the last one, which the encoder drops, so they are zeros everywhere.
    Joins broadcast a dictionary only where Spark finds it small enough; else they shuffle, and hot values split.
    """
    spark = counts.sparkSession
    category_dictionary(counts, **options).write.mode("overwrite").partitionBy("feature").parquet(path)
    sizes = {row.feature: row.n for row in counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per column
    joins = " ".join(
        f"left join (select text, place from parquet.`{path}` where feature = {sql_text(c)}) d{i} on d{i}.text = t.`{c}__text`"
        for i, c in enumerate(categorical)
    )
    places = ", ".join(f"cast(coalesce(d{i}.place, {sizes[c]}) as double) as `{c}__index`" for i, c in enumerate(categorical))
    indices = [f"{c}__index" for c in categorical]
    widths = spark.createDataFrame([tuple(float(sizes[c]) for c in categorical)], ", ".join(f"`{c}` double" for c in indices))
    encoder = OneHotEncoder(inputCols=indices, outputCols=[f"{c}__hot" for c in categorical], dropLast=True)
    return [SQLTransformer(statement=f"select t.*, {places} from __THIS__ t {joins}"), encoder.fit(widths)]


def _label_stages(categories: dict[str, list[str]], categorical: Sequence[str]) -> list:
    return [
        *[StringIndexerModel.from_labels(categories[c], f"{c}__text", f"{c}__index", "keep") for c in categorical],
        # "keep" adds one index for unknown values and dropLast removes it again.
        OneHotEncoder(
            inputCols=[f"{c}__index" for c in categorical], outputCols=[f"{c}__hot" for c in categorical], dropLast=True
        ),
    ]


def fit_preparation(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
    dictionary: str | None = None, widest: int = WIDEST_ENCODING, **options,
) -> Pipeline:
    """Stages that turn raw columns into ``features``; all are built in, so models save and load.

    Missing numbers get the training median, then are centred and divided by
    the population deviation. Missing categories get the mode; categories not
    seen in training encode as all zeros. Categories of more than ``widest``
    texts in all are kept as a table at ``dictionary`` (else in the shared
    folder), which the saved model refers to and which must stay there.
    """
    counts = materialize(text_counts(df, categorical)) if categorical else None
    fill = fit_fill_values(df, numeric, categorical, counts, **options)
    scale = fit_scale(impute(df.select(*numeric), FillValues(fill.medians)), numeric) if numeric else {}
    expressions = []
    types = dict(df.dtypes)
    for c in numeric:
        mean, deviation = scale[c]
        known = f"coalesce(nanvl(cast(`{c}` as double), cast(null as double)), {sql_number(fill.medians[c])})"
        expressions.append(f"({known} - {sql_number(mean)}) / {sql_number(deviation)} as `{c}__scaled`")
    for c in categorical:
        expressions.append(f"coalesce({known_text(c, types[c])}, {sql_text(fill.modes[c])}) as `{c}__text`")
    stages = [SQLTransformer(statement=f"select *, {', '.join(expressions)} from __THIS__")]
    inputs = [f"{c}__scaled" for c in numeric]
    if categorical:
        if counts.count() > widest:
            stages += _dictionary_stages(counts, categorical, dictionary or scratch_path(df.sparkSession, "categories"), **options)
        else:
            stages += _label_stages(fit_categories(counts, widest), categorical)
        inputs += [f"{c}__hot" for c in categorical]
        discard(counts)
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])
