"""Column names, binding of features and target, validation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import is_missing
from ..storage import discard, materialize_checked


def normalize_name(name: object) -> str:
    """snake_case, then the dataset's aliases."""
    snake = "_".join(re.findall("[a-zA-Z0-9]+", str(name))).lower()
    if snake in config.TARGET_ALIASES:
        return config.TARGET
    generic = re.fullmatch(r"x([1-9]\d*)", snake)
    if generic and int(generic[1]) <= len(config.FEATURE_COLUMNS):
        return config.FEATURE_COLUMNS[int(generic[1]) - 1]
    return snake


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename by position, after checking that no two names become one."""
    names = [normalize_name(c) for c in df.columns]
    duplicates = sorted({n for n in names if names.count(n) > 1})
    if duplicates:
        given = [c for c, n in zip(df.columns, names) if n in duplicates]
        raise ValueError(f"several columns {given} would share the names {duplicates}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: Sequence[str], what: str = "columns") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing {what}: {missing}; found {df.columns}")
    return df


def bind_features_target(features: DataFrame, target: DataFrame, key: str = config.ROW_ID) -> DataFrame:
    """Attach the target by key. A row without a partner keeps nulls, which validation rejects.

    The target is folded to one row per key first, so a repeated key cannot
    multiply rows; a key with several targets gets null. One full outer join
    on the key follows, on the partitioning of that fold.
    """
    columns = [c for c in target.columns if c != key]
    once = (
        target.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in columns])
        .select(key, *[F.when(F.col("_n") == 1, F.col(c)).alias(c) for c in columns])
    )
    return features.join(once, key, "full_outer")


def partition_columns(
    columns: Sequence[str], categorical: Sequence[str] = config.CATEGORICAL_COLUMNS
) -> tuple[list[str], list[str]]:
    """(numeric in table order, categorical in configured order)."""
    present = [c for c in categorical if c in columns]
    return [c for c in columns if c not in present], present


def split_features_target(df: DataFrame, target: str = config.TARGET) -> tuple[DataFrame, DataFrame]:
    """Two projections of one table; rows keep their key, so nothing relies on order."""
    require_columns(df, [target], "target column")
    keys = [c for c in (config.ROW_ID,) if c in df.columns]
    return df.drop(target), df.select(*keys, F.col(target).cast("int").alias(target))


def validation_checks(df: DataFrame, target: str = config.TARGET) -> dict[str, Column]:
    """Aggregates by name: missing values per column, target values that are no number, or not 0 or 1."""
    number = F.expr(f"try_cast(`{target}` as double)")
    checks: dict[str, Column] = {}
    for name, data_type in df.dtypes:
        missing = is_missing(f"`{name}`", data_type)
        checks[f"{name}|nulls"] = F.count_if(missing)
        if name == target:
            checks["bad_cast"] = F.count_if(~missing & number.isNull())
            checks["bad_domain"] = F.count_if(~missing & ~number.isin(0.0, 1.0))
    return checks


def validation_report(df: DataFrame, target: str = config.TARGET) -> DataFrame:
    """One row per column: the results of :func:`validation_checks`."""
    one = df.agg(*[check.alias(name) for name, check in validation_checks(df, target).items()])
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"`{name}|nulls`").alias("nulls"),
            (F.col("bad_cast") if name == target else F.lit(0).cast("long")).alias("bad_cast"),
            (F.col("bad_domain") if name == target else F.lit(0).cast("long")).alias("bad_domain"),
        )
        for name in df.columns
    ]
    return one.select(F.inline(F.array(*rows)))


def raise_faults(seen: dict[str, int], target: str = config.TARGET) -> None:
    """Raise on the first kind of fault that :func:`validation_checks` counted."""
    if seen["bad_cast"]:
        raise ValueError(f"{seen['bad_cast']} values of {target} are no numbers")
    if seen["bad_domain"]:
        raise ValueError(f"{seen['bad_domain']} values of {target} are neither 0 nor 1")
    missing = {name.removesuffix("|nulls"): n for name, n in seen.items() if name.endswith("|nulls") and n}
    if missing:
        raise ValueError(f"rows with missing values, by column: {missing}")


def _integer_target(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, F.col(target).cast("double").cast("tinyint"))


def require_valid(df: DataFrame, target: str = config.TARGET) -> DataFrame:
    """Raise on the first kind of fault found, else return ``df`` with an integer target."""
    require_columns(df, [target], "target column")
    raise_faults(df.agg(*[check.alias(name) for name, check in validation_checks(df, target).items()]).first().asDict(), target)
    return _integer_target(df, target)


def materialize_valid(df: DataFrame, target: str = config.TARGET) -> DataFrame:
    """:func:`require_valid` for a table that is costly to compute: it is written once, and what was written is checked."""
    require_columns(df, [target], "target column")
    done, seen = materialize_checked(df, **validation_checks(df, target))
    try:
        raise_faults(seen, target)
    except ValueError:
        discard(done)
        raise
    return _integer_target(done, target)


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a key occurs twice, wherever its rows are. Keys fold in the map-side aggregation before they meet."""
    if not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        raise ValueError(f"{key} is not unique")


def normalize_dataset(
    features: DataFrame, target: DataFrame, key: str = config.ROW_ID, validate: bool = True
) -> DataFrame:
    """Bind, rename, drop ``id``, validate. The key stays as a column.

    Validation computes the join once, into a table of the shared folder.
    """
    bound = normalize_columns(bind_features_target(features, target, key))
    require_columns(bound, [config.TARGET], "target column")
    bound = bound.drop("id")
    return materialize_valid(bound) if validate else bound
