"""Column expressions used by the operators. All are built-in and codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: Column | str, data_type: str = "double") -> Column:
    """Null, or NaN for floating-point columns."""
    c = _col(c)
    return (c.isNull() | F.isnan(c)) if data_type in ("double", "float") else c.isNull()


def sql_number(x: float) -> str:
    """Double literal."""
    return f"{float(x)!r}D"


def sql_text(x: str) -> str:
    escaped = x.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def decision(p: str, threshold: float = config.DECISION_THRESHOLD) -> Column:
    """1 from the threshold up. Spark orders NaN above every number, hence the guard."""
    return F.expr(f"cast(`{p}` >= {sql_number(threshold)} and not isnan(`{p}`) as int)")


def risk_band(p: str) -> Column:
    """Left-closed bands: low, review, high. NaN and null belong to no band."""
    low, review, high = config.BANDS
    return F.expr(
        f"case when `{p}` is null or isnan(`{p}`) then null"
        f" when `{p}` < {sql_number(config.REVIEW_FROM)} then '{low}'"
        f" when `{p}` < {sql_number(config.HIGH_FROM)} then '{review}' else '{high}' end"
    )


def unit_edges(bins: int = config.CALIBRATION_BINS) -> list[float]:
    """Evenly spaced edges on [0, 1]: index times step, like a numeric range."""
    return [k * (1.0 / bins) for k in range(bins)] + [1.0]


def calibration_bin(p: str, bins: int = config.CALIBRATION_BINS) -> Column:
    """Right-closed bin 1..bins; the lowest edge belongs to bin 1; null outside [0, 1]."""
    above = " + ".join(f"int(`{p}` > {sql_number(e)})" for e in unit_edges(bins)[1:-1])
    return F.expr(f"case when `{p}` between 0D and 1D then 1 + {above} end")


def calibration_label(bin_index: str, bins: int = config.CALIBRATION_BINS) -> Column:
    """Interval text of a bin, e.g. ``(0.1, 0.2]``; the lowest starts just below zero."""
    edges = [f"{e:.3g}" for e in unit_edges(bins)]
    edges = [e if "." in e else e + ".0" for e in edges]
    lows = ["-0.001", *edges[1:-1]]
    labels = ", ".join(f"'({low}, {high}]'" for low, high in zip(lows, edges[1:]))
    return F.expr(f"element_at(array({labels}), {bin_index})")


def drift_status(psi: str) -> Column:
    return F.expr(
        f"case when {psi} >= {sql_number(config.ALERT_PSI)} then 'alert'"
        f" when {psi} >= {sql_number(config.WATCH_PSI)} then 'watch' else 'stable' end"
    )


def all_close(reference: str, value: str) -> str:
    """SQL: |reference - value| within 1e-8 + 1e-5 * |value|."""
    return f"abs({reference} - {value}) <= 1e-8D + 1e-5D * abs({value})"


def ratio(numerator: str, denominator: str) -> str:
    """SQL: a ratio that is 0 where the denominator is 0."""
    return f"coalesce(try_divide({numerator}, {denominator}), 0D)"


def seeded_hash(seed: int | str | Column, key: Column | str) -> Column:
    """Hex md5 of ``seed:key``: a seeded random order that is the same on every engine."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", seed.cast("string"), _col(key).cast("string")))


def snake_case(c: Column | str) -> Column:
    """Runs of non-alphanumerics become ``_``; trimmed and lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(_col(c), "[^a-zA-Z0-9]+", "_"), "^_|_$", ""))


def known_text(c: str, data_type: str) -> str:
    """SQL: a category as text; null where it is null, or NaN in a floating-point column."""
    value = f"nanvl(`{c}`, cast(null as {data_type}))" if data_type in ("double", "float") else f"`{c}`"
    return f"cast({value} as string)"


def slice_value(c: str, data_type: str) -> Column:
    """A group value as text; missing values form the group ``nan``."""
    return F.coalesce(F.expr(known_text(c, data_type)), F.lit("nan"))


def utc_stamp(ts: Column | None = None) -> Column:
    """``yyyyMMddTHHmmssZ`` in UTC, whatever the session time zone."""
    ts = F.current_timestamp() if ts is None else ts
    return F.date_format(
        F.to_utc_timestamp(ts, F.current_timezone()), "yyyyMMdd'T'HHmmss'Z'"
    )
