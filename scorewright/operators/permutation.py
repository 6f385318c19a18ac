"""Permutation importance by average precision, all features in one job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from .metrics import AVERAGE_PRECISION, ranked_scores, score_table
from .sampling import seeded_donors

_NONE = ""


def permutation_importance(
    test: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    columns: Sequence[str],
    *,
    label: str = "label",
    key: str = config.ROW_ID,
    repeats: int = config.PERMUTATION_REPEATS,
    seed: int = config.SEED,
    per_column: bool = False,
    **options,
) -> DataFrame:
    """Loss of average precision when one raw column is shuffled, mean over repeats.

    ``score`` adds a column ``p`` to a table with ``columns``. All features use
    the same shuffle within a repeat, so each row meets one donor row per
    repeat, whatever the number of features; ``per_column`` shuffles every
    feature on its own instead. The unshuffled baseline is scored along with
    the rest.
    """
    columns = list(columns)
    donors = seeded_donors(
        test.select(key, label, *columns), columns,
        repeats=repeats, key=key, seed=seed, per_column=per_column,
    )
    variants = _variants(donors, columns, per_column).select(
        key, label, "feature", "repeat",
        *[F.when(F.col("feature") == c, F.col("donor")[c]).otherwise(F.col(c)).alias(c) for c in columns],
    )
    scored = score(variants)
    return _losses(scored.select(label, _place(columns), "repeat", "p"), columns, label, **options)


def _variants(donors: DataFrame, columns: Sequence[str], per_column: bool = False) -> DataFrame:
    """A row for each ``feature`` that is shuffled, and once a row for none."""
    own = F.array("shuffled") if per_column else F.array(*[F.lit(c) for c in columns])
    opens = (F.col("repeat") == 1) & ((F.col("shuffled") == columns[0]) if per_column else F.lit(True))
    features = F.when(opens, F.concat(F.array(F.lit(_NONE)), own)).otherwise(own)
    return donors.withColumn("feature", F.explode(features))


def _place(columns: Sequence[str]) -> Column:
    """The place of ``feature`` among ``columns``: a number is shuffled and sorted at less cost than a name."""
    return F.coalesce(F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature")), F.lit(0)).cast("int").alias("place")


def _losses(scored: DataFrame, columns: Sequence[str], label: str, **options) -> DataFrame:
    """Mean loss per feature of scored variants; a variant's ``place`` is that of its feature in ``columns`` from 1, 0 for none."""
    by = ["place", "repeat"]
    table = score_table(scored, by, label)
    precision = ranked_scores(table, by, **options).groupBy(*by).agg(F.expr(AVERAGE_PRECISION).alias("ap"))
    # From here on there are (features * repeats + 1) rows.
    baseline = F.max(F.when(F.col("place") == 0, F.col("ap"))).over(Window.partitionBy())
    names = F.array(*[F.lit(c) for c in columns])
    return (
        precision.withColumn("loss", baseline - F.col("ap"))
        .filter(F.col("place") > 0)
        .groupBy("place").agg(F.round(F.avg("loss"), 6).alias("importance"))
        .select(F.get(names, F.col("place") - 1).alias("feature"), "importance", F.col("place").alias("position"))
    )


def _flat(model: PipelineModel) -> list:
    return [inner for s in model.stages for inner in (_flat(s) if isinstance(s, PipelineModel) else [s])]


def linear_terms(model: PipelineModel, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """``df`` with ``terms``: what each raw column adds to the margin of a fitted linear pipeline, in the columns' order.

    The pipeline is one of :func:`fit_preparation` and a linear model. A number adds its scaled value times its
    coefficient, a category the coefficient of its place, an unknown one nothing.
    """
    beta, at, terms = model.stages[-1].coefficients.toArray().tolist(), len(numeric), []
    for coefficient, c in zip(beta, numeric):
        terms.append(F.col(f"{c}__scaled") * F.lit(coefficient))
    prepared = df
    for stage in model.stages[:-1]:
        prepared = stage.transform(prepared)
    encoders = [s for s in _flat(model) if isinstance(s, OneHotEncoderModel)]
    hot = dict(zip(categorical, encoders[0].categorySizes)) if encoders else {}
    for c in categorical:
        width = hot[c] - 1  # the last place is that of unknown values
        own = F.array(*map(F.lit, beta[at : at + width])) if width else F.array(F.lit(0.0))
        terms.append(F.coalesce(F.get(own, F.col(f"{c}__index").cast("int")), F.lit(0.0)))
        at += width
    return prepared.select(*df.columns, F.array(*terms).alias("terms"))


def linear_importance(
    model: PipelineModel,
    test: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    *,
    order: Sequence[str] = (),
    label: str = "label",
    key: str = config.ROW_ID,
    repeats: int = config.PERMUTATION_REPEATS,
    seed: int = config.SEED,
    per_column: bool = False,
    **options,
) -> DataFrame:
    """:func:`permutation_importance` of a linear pipeline, whose rows pass the pipeline only once.

    Positions are those in ``order``, else numbers first.

    Each row's margin is a sum of one term per raw column, so a shuffled column changes its own term: donors
    give terms instead of values. Terms are always added in the same order, so equal rows keep equal scores.
    """
    columns = [*numeric, *categorical]
    terms = linear_terms(model, test, numeric, categorical)
    terms = terms.select(key, label, *[F.col("terms")[i].alias(c) for i, c in enumerate(columns)])
    donors = seeded_donors(terms, columns, repeats=repeats, key=key, seed=seed, per_column=per_column)

    def probability(changed: str | None = None) -> Column:
        margin = F.lit(float(model.stages[-1].intercept))
        for c in columns:
            margin = margin + (F.col("donor")[c] if c == changed else F.col(c))
        return 1.0 / (1.0 + F.exp(-margin))

    # All variants of a row are scored side by side and leave it as (place, p): nothing else of the row is repeated.
    order = [*order, *(c for c in columns if c not in order)]
    variant = {c: F.struct(F.lit(order.index(c) + 1).alias("place"), probability(c).alias("p")) for c in columns}
    plain = F.struct(F.lit(0).alias("place"), probability().alias("p"))
    if per_column:
        own = F.array(F.coalesce(*[F.when(F.col("shuffled") == c, v) for c, v in variant.items()]))
        opens = (F.col("repeat") == 1) & (F.col("shuffled") == columns[0])
    else:
        own, opens = F.array(*variant.values()), F.col("repeat") == 1
    scored = donors.select(label, "repeat", F.inline(F.when(opens, F.concat(F.array(plain), own)).otherwise(own)))
    return _losses(scored, order, label, **options)


def top_features(importance: DataFrame, k: int = config.TOP_FEATURES) -> DataFrame:
    """The ``k`` largest, ties in column order."""
    return importance.orderBy(F.desc("importance"), "position").limit(k)
