"""Exact stratified splits and seeded shuffles without a global sort."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import seeded_hash
from .schema import require_unique
from ..storage import discard, materialize, materialize_checked, pin

Counts = dict[int, int]

# A hash cell is the first hex digits of the hash: 16**4 cells of equal size.
_CELL_DIGITS = 4
# A cell of a cut that holds more rows is divided further before it is ranked.
_ROWS_PER_CELL = 50_000


def allocate(counts: Counts, draws: int) -> Counts:
    """Split ``draws`` over the classes in proportion: floor, then largest remainder."""
    total = sum(counts.values())
    exact = {c: n * draws / total for c, n in counts.items()}
    given = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(counts, key=lambda c: (given[c] - exact[c], c))
    for c in by_remainder[: draws - sum(given.values())]:
        given[c] += 1
    return given


def two_way(counts: Counts, test_size: float = config.TEST_SIZE) -> dict[str, Counts]:
    """Class counts of train and test; the test part is rounded up."""
    total = sum(counts.values())
    train = allocate(counts, total - math.ceil(test_size * total))
    return {"train": train, "test": {c: counts[c] - train[c] for c in counts}}


def three_way(counts: Counts, holdout: float = config.HOLDOUT_SIZE) -> dict[str, Counts]:
    """Train, and the held-out part halved into validation and transform."""
    first = two_way(counts, holdout)
    second = two_way(first["test"], 0.5)
    return {"train": first["train"], "validation": second["train"], "transform": second["test"]}


def stratified_split(
    df: DataFrame,
    sizes: Callable[[Counts], dict[str, Counts]] = two_way,
    *,
    key: str = config.ROW_ID,
    label: str = "label",
    seed: int = config.SEED,
) -> DataFrame:
    """Add ``split``: each class is cut at exact counts of its seeded random order.

    Only the cut points are computed: a histogram of hash cells finds the cell
    a cut falls in, and only that cell's rows are ranked. The rows themselves
    are then labelled by comparing them to the cuts, without a shuffle. ``key``
    must be unique and ``label`` 0 or 1.
    """
    require_unique(df, key)
    order = seeded_hash(seed, key)
    keyed = df.select(
        F.col(label).alias("c"), F.col(key).alias("k"), order.alias("h"),
        F.substring(order, 1, _CELL_DIGITS).alias("cell"),
    )
    # At most 16**4 rows per class.
    cells = pin(keyed.groupBy("c", "cell").agg(F.count(F.lit(1)).alias("n")))
    strange = cells.filter(F.col("c").isNull() | ~F.col("c").cast("double").isin(0.0, 1.0)).agg(F.sum("n")).first()[0]
    if strange:
        raise ValueError(f"{label} must be 0 or 1 to be split by class; {strange} rows hold something else")
    classes = {row[0]: row[1] for row in cells.groupBy("c").agg(F.sum("n")).collect()}
    parts = sizes(classes)
    names = list(parts)
    targets, done = [], dict.fromkeys(classes, 0)
    for name in names[:-1]:
        for c in classes:
            done[c] += parts[name][c]
            targets.append((c, name, done[c]))

    cuts = _cut_points(keyed, cells, targets, key)
    split = F.lit(names[-1])
    for name in reversed(names[:-1]):
        inside = F.lit(False)
        for c in classes:
            if (c, name) in cuts:
                h, k = cuts[c, name]
                within = (order < h) | ((order == h) & (F.col(key) <= F.lit(k)))
                inside = inside | ((F.col(label) == F.lit(c)) & within)
        split = F.when(inside, name).otherwise(split)
    return df.withColumn("split", split)


def _cut_points(keyed: DataFrame, cells: DataFrame, targets: list, key: str) -> dict:
    """(class, part) -> (hash, key) of the part's last row."""
    label_type = keyed.schema["c"].dataType.simpleString()
    wanted = keyed.sparkSession.createDataFrame(
        [t for t in targets if t[2] > 0], f"c {label_type}, part string, rank bigint"
    )
    keyed = keyed.drop("cell")
    cells = cells.join(F.broadcast(wanted), "c")  # one row per class and cut
    digits = _CELL_DIGITS
    while True:
        upto = F.sum("n").over(Window.partitionBy("c", "part").orderBy("cell"))
        crossing = pin(
            cells.withColumn("upto", upto)
            .filter((F.col("upto") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
            .select("c", "cell", "part", (F.col("rank") - (F.col("upto") - F.col("n"))).alias("rank"), "n")
        )
        largest = crossing.agg(F.max("n")).first()[0] or 0
        inside = keyed.withColumn("cell", F.substring("h", 1, digits)).join(F.broadcast(crossing.drop("n")), ["c", "cell"])
        if largest <= _ROWS_PER_CELL or digits >= 28:
            break
        digits += _CELL_DIGITS
        cells = pin(
            inside.withColumn("cell", F.substring("h", 1, digits)).groupBy("c", "part", "rank", "cell").agg(F.count(F.lit(1)).alias("n"))
        )
    in_cell = Window.partitionBy("c", "part").orderBy("h", "k")
    found = (
        inside.withColumn("row", F.row_number().over(in_cell))
        .filter(F.col("row") == F.col("rank"))
        .select("c", "part", "h", "k").collect()  # one row per class and cut
    )
    return {(row.c, row.part): (row.h, row.k) for row in found}


def seeded_donors(
    df: DataFrame,
    columns: Sequence[str],
    *,
    repeats: int = config.PERMUTATION_REPEATS,
    key: str = config.ROW_ID,
    seed: int = config.SEED,
    per_column: bool = False,
    rows_per_task: int = config.ROWS_PER_TASK,
) -> DataFrame:
    """Add ``repeat`` and ``donor``: another row's ``columns``, each row donating once.

    Per repeat all rows stand in one seeded random order, and each takes the
    values of the row before it; the first takes the last's. A new row changes
    the donor of one old row only. With ``per_column`` every column has an
    order of its own: rows are repeated per column, named in ``shuffled``.

    The order is cut into ranges of a bounded number of rows; the first row of
    a range looks up the last row of the range before.
    """
    order = [F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")]
    repeated = df.select("*", *order)
    cycle, salt = ["repeat"], [F.lit(str(seed)), F.col("repeat").cast("string")]
    if per_column:
        repeated = repeated.withColumn("shuffled", F.explode(F.array(*[F.lit(c) for c in columns])))
        cycle, salt = [*cycle, "shuffled"], [*salt, F.col("shuffled")]
    hashed, seen = materialize_checked(repeated.withColumn("_h", seeded_hash(F.concat_ws(":", *salt), key)))
    ranges = max(df.sparkSession.sparkContext.defaultParallelism, -(-seen["rows"] // rows_per_task))
    ranged = materialize(hashed.repartitionByRange(ranges, *cycle, "_h", key).withColumn("_range", F.spark_partition_id()))
    discard(hashed)

    values = F.struct(*columns)
    # One row per range and cycle.
    last = ranged.groupBy(*cycle, "_range").agg(F.max_by(values, F.struct("_h", key)).alias("_last"))
    along = Window.partitionBy(*cycle).orderBy("_range")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = last.select(*cycle, "_range", F.coalesce(F.lag("_last").over(along), F.last("_last").over(whole)).alias("_before"))
    inside = Window.partitionBy(*cycle, "_range").orderBy("_h", key)
    donors = ranged.withColumn("_lag", F.lag(values).over(inside)).join(before, [*cycle, "_range"])
    found = donors.withColumn("donor", F.coalesce("_lag", "_before"))
    return found.select(*df.columns, *cycle, "donor")
