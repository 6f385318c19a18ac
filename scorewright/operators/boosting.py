"""Gradient boosting over many rows: the trees of ``GBTClassifier``, from histograms that numpy adds up over blocks of rows.

Every round grows one tree of depth d in d jobs over all rows. A job returns counts and sums of residuals per node and bin,
whose size depends on bins, features and nodes only; rows stay on the executors as binned blocks with their margins.
"""

from __future__ import annotations

import json
import math
import pickle
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import delete, scratch_path, shared_folder
from .ensembles import WIDEST_DENSE

# Rows from which boosting runs in blocks. Fewer are the classifier's own, whose jobs are then short.
BLOCKS_FROM = 500_000
# Rows of a block: its columns stay in a core's cache.
_BLOCK = 32_768
# Rows that a task of a fit should hold, at least and at most.
_ROWS_PER_TASK = 4 * _BLOCK, 128 * _BLOCK
# Partial histograms that the driver adds up itself; more are added up on the executors first.
_PARTIALS = 128
# Values from which the classifier takes thresholds: this many, or the square of the bins.
_SAMPLE = 10_000


@dataclass(frozen=True)
class _Layout:
    """What the bins mean: thresholds per number, and the features that are 0 or 1."""

    width: int
    numbers: Sequence[int]
    flags: Sequence[int]
    thresholds: Sequence[np.ndarray]

    @property
    def bins(self) -> int:
        return max([len(t) for t in self.thresholds], default=0) + 1


@dataclass
class _Node:
    """A node of a growing tree. ``cut`` is (feature, last bin of the left side) or, of a flag, (feature, value that goes left)."""

    rows: float = 0.0
    total: float = 0.0
    squares: float = 0.0
    gain: float = -1.0
    cut: tuple[int, int] | None = None

    @property
    def prediction(self) -> float:
        return self.total / self.rows if self.rows else 0.0

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.rows) / self.rows if self.rows else 0.0


def _kinds(prepared: DataFrame, column: str) -> tuple[int, list[int], list[int]] | None:
    """Width, numbers and 0/1 features of the vectors, if their metadata says so of every position."""
    about = prepared.schema[column].metadata.get("ml_attr", {})
    found = {kind: sorted(a["idx"] for a in attrs) for kind, attrs in about.get("attrs", {}).items()}
    numbers, flags = found.pop("numeric", []), found.pop("binary", [])
    width = about.get("num_attrs", -1)
    return None if found or sorted(numbers + flags) != list(range(width)) else (width, numbers, flags)


def _thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """Middles between distinct values: all, or those nearest to ``most`` cuts into equal numbers of rows."""
    found, counts = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = len(values) / (most + 1)
    chosen, target, upto = [], stride, np.cumsum(counts)
    for i, middle in enumerate(middles):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            chosen.append(middle)
            target += stride
    return np.array(chosen)


def _layout(booster: GBTClassifier, arrays: DataFrame, rows: int, kinds: tuple[int, list[int], list[int]]) -> _Layout:
    """Thresholds from a seeded sample of as many rows as the classifier takes; the driver gets its numbers."""
    width, numbers, flags = kinds
    wanted = max(booster.getMaxBins() ** 2, _SAMPLE)
    sample = arrays if rows <= wanted else arrays.sample(fraction=wanted / rows, seed=booster.getSeed())
    values = sample.select(*[F.col("x")[f].alias(f"x{f}") for f in numbers]).toArrow() if numbers else None
    thresholds = [_thresholds(values.column(i).to_numpy(), booster.getMaxBins() - 1) for i in range(len(numbers))]
    return _Layout(width, numbers, flags, thresholds)


def _blocks(arrays: DataFrame, layout: _Layout, partitions: int) -> RDD:
    """(bins per number, numbers of the flags that are set, labels as -1 and 1, margins, its place) per block of rows, evenly dealt."""
    numbers, flags, thresholds, block = list(layout.numbers), list(layout.flags), layout.thresholds, _BLOCK
    small = np.uint8 if max(layout.bins, len(flags) + 1) <= 256 else np.uint16

    def build(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), count()

        def packed(held: list) -> pa.RecordBatch:
            y = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in held])
            x = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in held]).reshape(len(y), -1)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("Labels of boosting must be 0 or 1")
            if not np.isfinite(x).all() or not np.isin(x[:, flags], (0.0, 1.0)).all():
                raise ValueError("Features of boosting must be finite, and flags 0 or 1")
            codes = np.empty((len(numbers), len(y)), small)
            for i, (f, t) in enumerate(zip(numbers, thresholds)):
                codes[i] = np.searchsorted(t, x[:, f], side="left")
            at, which = np.nonzero(x[:, flags])
            place = np.arange(len(at)) - np.searchsorted(at, at, side="left")  # of a flag among those of its row
            given = np.zeros((place.max(initial=-1) + 1, len(y)), small)
            given[place, at] = which + 1
            state = codes, given, (2 * y - 1).astype(np.int8), np.zeros(len(y)), (task, next(made))
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state, protocol=5)], pa.binary())], ["block"])

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, block - n)
                batch = batch.slice(taken.num_rows)
                held.append(taken)
                n += taken.num_rows
                if n == block:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    return arrays.mapInArrow(build, "block binary").repartition(partitions).rdd.map(lambda row: pickle.loads(row.block))


def _questions(tree: dict, layout: _Layout) -> list[list[tuple]]:
    """Per level (place in the level, whether a flag, its row or number, last bin or value that goes left) of the inner nodes."""
    levels: list[list[tuple]] = []
    for (depth, place), node in sorted(tree.items()):
        if node.cut:
            feature, left = node.cut
            flag = feature in layout.flags
            levels.extend([] for _ in range(depth + 1 - len(levels)))
            levels[depth].append((place, flag, layout.flags.index(feature) + 1 if flag else layout.numbers.index(feature), left))
    return levels


def _places(levels: list[list[tuple]]) -> Callable:
    """The place of a block's rows in the level below ``levels``; leaves above it count as their own left children."""

    def places(codes: np.ndarray, given: np.ndarray) -> np.ndarray:
        import numpy as np

        at = np.zeros(codes.shape[1], np.uint8)
        for level in levels:
            right = np.zeros(len(at), bool)
            for place, flag, row, left in level:
                goes = (given == row).any(axis=0) != bool(left) if flag else codes[row] > left
                right |= goes & (at == place)
            at = 2 * at + right.view(np.uint8)
        return at

    return places


def _draws(rate: float, seed: int, tree: int) -> Callable | None:
    """Which rows of a block a tree learns from: each with the chance ``rate``, the same ones whenever the block is read again."""
    if rate == 1.0:
        return None

    def drawn(own: tuple[int, int], rows: int) -> np.ndarray:
        import numpy as np

        return np.random.default_rng([seed, tree, *own]).random(rows, np.float32) < rate

    return drawn


def _per_node(strategy: str, width: int) -> int | None:
    """Features that a node may choose among, if the strategy is all or a share of them."""
    if strategy in ("all", "auto"):
        return width
    return math.ceil(float(strategy) * width) if re.fullmatch(r"0?\.\d*[1-9]\d*|1\.0+", strategy) else None


def _grown(state: RDD, levels: list[list[tuple]], values: Sequence[float]) -> RDD:
    """Blocks whose margins have gained a tree, given by its questions and the weighted predictions of its lowest level."""
    places, gains = _places(levels), np.array(values)

    def grow(block: tuple) -> tuple:
        codes, given, sign, margin, own = block
        return codes, given, sign, margin + gains[places(codes, given)], own

    return state.map(grow)


def _sums(state: RDD, levels: list[list[tuple]], chosen: Sequence[int], layout: _Layout, first: bool, drawn: Callable | None) -> tuple:
    """Rows, residuals and their squares at the ``chosen`` places of a level: (3, numbers, places, bins) and (3, places, flags).

    Also their totals (3, places). Residuals are minus the slope of the logistic loss; the first tree learns the signs themselves.
    """
    places, nodes = _places(levels), len(chosen)
    numbers, bins, flags = len(layout.numbers), layout.bins, len(layout.flags) + 1
    number = np.full(2 ** len(levels), nodes, np.int64)
    number[list(chosen)] = range(nodes)
    picked = number < nodes

    def part(blocks: Iterable[tuple]) -> Iterable[tuple]:
        import numpy as np

        totals, by_number, by_flag = np.zeros((3, nodes)), np.zeros((3, numbers, nodes, bins)), np.zeros((3, nodes, flags))
        for codes, given, sign, margin, own in blocks:
            at = places(codes, given)
            if drawn or not picked.all():
                rows = np.flatnonzero(picked[at] & drawn(own, len(at)) if drawn else picked[at])
                at, codes, given, sign, margin = at[rows], [c[rows] for c in codes], [g[rows] for g in given], sign[rows], margin[rows]
            at = number[at]
            residual = sign.astype(float) if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))
            weights = None, residual, residual * residual
            for k, w in enumerate(weights):
                totals[k] += np.bincount(at, w, nodes)
            by_bin, by_set = at * bins, at * flags
            for i, c in enumerate(codes):
                cells = by_bin + c
                for k, w in enumerate(weights):
                    by_number[k, i] += np.bincount(cells, w, nodes * bins).reshape(nodes, bins)
            for g in given:
                cells = by_set + g
                for k, w in enumerate(weights):
                    by_flag[k] += np.bincount(cells, w, nodes * flags).reshape(nodes, flags)
        return [(totals, by_number, by_flag)]

    def add(a: tuple, b: tuple) -> tuple:
        return tuple(x + y for x, y in zip(a, b))

    partial = state.mapPartitions(part)
    totals, by_number, by_flag = partial.treeReduce(add) if state.getNumPartitions() > _PARTIALS else reduce(add, partial.collect())
    return totals, by_number, by_flag[:, :, 1:]


def _best_cut(
    node: _Node, by_number: np.ndarray, by_flag: np.ndarray, features: Sequence[int], layout: _Layout, booster: GBTClassifier
) -> tuple[float, tuple[int, int], np.ndarray] | None:
    """Gain, cut and the left side's statistics of a node's best cut by one of ``features``; ties go to the first feature, then the first bin."""
    whole, widest = np.array([node.rows, node.total, node.squares]), max(layout.bins - 1, 1)
    left = np.zeros((3, layout.width, widest))
    for i, (f, t) in enumerate(zip(layout.numbers, layout.thresholds)):
        left[:, f, : len(t)] = np.cumsum(by_number[:, i], axis=1)[:, : len(t)]
    values = np.zeros(layout.width, int)  # that go left: of a flag the one with the lower mean, 0 if equal
    if layout.flags:
        flags, ones = list(layout.flags), by_flag
        zeros = whole[:, None] - ones
        with np.errstate(divide="ignore", invalid="ignore"):
            lower = ones[1] / ones[0] < zeros[1] / zeros[0]
        values[flags] = lower
        left[:, flags, 0] = np.where(lower, ones, zeros)
    right = whole[:, None, None] - left
    least = max(booster.getMinInstancesPerNode(), 1)
    allowed = (left[0] >= least) & (right[0] >= least) & np.isin(np.arange(layout.width), features)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = left[0] * right[0] / node.rows**2 * (left[1] / left[0] - right[1] / right[0]) ** 2
    gains = np.where(allowed, gains, -np.inf)
    feature, split = np.unravel_index(np.argmax(gains), gains.shape)
    gain = float(gains[feature, split])
    if gain <= np.finfo(float).eps * node.squares / node.rows or gain < booster.getMinInfoGain():  # no more than rounding
        return None
    return gain, (int(feature), int(values[feature] if feature in layout.flags else split)), left[:, feature, split]


def _tree(state: RDD, layout: _Layout, booster: GBTClassifier, number: int) -> dict[tuple[int, int], _Node]:
    """The ``number``-th tree by (depth, place in the level), grown a level a job.

    Sampled rows are drawn for the tree, and features for each of its nodes, seeded by the number of the tree. Rows are added up on the smaller side of a cut; the other side is what is left of the node above.
    """
    tree, active, above = {(0, 0): _Node()}, [0], {}
    seed = booster.getSeed() & 0xFFFFFFFFFFFFFFFF  # numpy takes no negative one
    drawn, chance = _draws(booster.getSubsamplingRate(), seed, number), np.random.default_rng([seed, number])
    per_node = _per_node(booster.getFeatureSubsetStrategy(), layout.width)
    for depth in range(booster.getMaxDepth()):
        chosen = active if not depth else [min(p, p + 1, key=lambda q: tree[depth, q].rows) for p in active[::2]]
        totals, by_number, by_flag = _sums(state, _questions(tree, layout), chosen, layout, number == 0, drawn)
        held = {place: (by_number[:, :, i], by_flag[:, i]) for i, place in enumerate(chosen)}
        if depth:
            held |= {p ^ 1: tuple(x - y for x, y in zip(above[p // 2], held[p])) for p in chosen}
        else:
            tree[0, 0] = _Node(*map(float, totals[:, 0]))
        below = []
        for place in active:
            node = tree[depth, place]
            features = chance.choice(layout.width, per_node, replace=False)
            if not node.rows or depth and abs(node.impurity) < np.finfo(float).eps:
                continue
            if found := _best_cut(node, *held[place], features, layout, booster):
                node.gain, node.cut, left = found
                sides = left, np.array([node.rows, node.total, node.squares]) - left
                tree[depth + 1, 2 * place], tree[depth + 1, 2 * place + 1] = (_Node(*map(float, side)) for side in sides)
                below += [2 * place, 2 * place + 1]
        active, above = below, held
        if not active:
            break
    return tree


def _lowest(tree: dict, depth: int, weight: float) -> list[float]:
    """Weighted prediction per place of the level at ``depth``, from the leaf above it."""
    found = [0.0] * 2**depth
    for (level, place), node in tree.items():
        if not node.cut:
            found[place << (depth - level)] = weight * node.prediction
    return found


def _node_rows(number: int, tree: dict, layout: _Layout) -> list[tuple]:
    """The tree's rows in a saved model: nodes in preorder, inner nodes whose two leaves predict the same as leaves."""
    rows: list = []

    def leaf(at: tuple[int, int]) -> float | None:
        """What a node predicts, if it is a leaf or all below it predicts the same."""
        if not tree[at].cut:
            return tree[at].prediction
        left, right = (leaf((at[0] + 1, 2 * at[1] + side)) for side in (0, 1))
        return left if left is not None and left == right else None

    def visit(at: tuple[int, int]) -> int:
        node, i = tree[at], len(rows)
        rows.append(None)
        known = node.prediction, node.impurity, [node.rows, node.total, node.squares], int(node.rows)
        same = leaf(at)
        if same is not None:
            rows[i] = number, (i, same, *known[1:], -1.0, -1, -1, (-1, [], -1))
            return i
        left, right = (visit((at[0] + 1, 2 * at[1] + side)) for side in (0, 1))
        feature, cut = node.cut
        split = (feature, [float(cut)], 2) if feature in layout.flags else (feature, [float(layout.thresholds[layout.numbers.index(feature)][cut])], -1)
        rows[i] = number, (i, *known, node.gain, left, right, split)
        return i

    visit((0, 0))
    return rows


def _model(spark: SparkSession, booster: GBTClassifier, trees: list[dict], weights: list[float], layout: _Layout) -> GBTClassificationModel:
    """The classifier's model of these trees: one that it fitted to two rows and saved, loaded with other trees."""
    path = scratch_path(spark, "boosting")
    two = spark.createDataFrame([(float(y), Vectors.dense([float(y)] * layout.width)) for y in (0, 1)], ["label", "features"])
    names = {booster.labelCol: "label", booster.featuresCol: "features", booster.maxIter: 1, booster.minInstancesPerNode: 1, booster.subsamplingRate: 1.0}
    booster.fit(two, names).save(f"{path}/template")
    about = json.loads(spark.read.text(f"{path}/template/metadata").first().value)
    own = {p.name: v for p, v in booster.extractParamMap().items() if booster.isSet(p)}
    about |= {"paramMap": own, "numTrees": len(trees), "numFeatures": layout.width}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    kept = spark.read.parquet(f"{path}/template/data")
    rows = [row for i, tree in enumerate(trees) for row in _node_rows(i, tree, layout)]
    spark.createDataFrame(rows, kept.schema).write.parquet(f"{path}/model/data")
    kept = spark.read.parquet(f"{path}/template/treesMetadata")
    one = kept.first()
    spark.createDataFrame([(i, one[1], weight) for i, weight in enumerate(weights)], kept.schema).write.parquet(f"{path}/model/treesMetadata")
    model = GBTClassificationModel.load(f"{path}/model")
    delete(spark, path)
    return model


def _in_blocks(booster: GBTClassifier, prepared: DataFrame, rows: int, kinds: tuple) -> GBTClassificationModel:
    spark = prepared.sparkSession
    shared_folder(spark)  # margins are checkpointed there
    arrays = prepared.select(F.col(booster.getLabelCol()).cast("double").alias("y"), vector_to_array(booster.getFeaturesCol()).alias("x"))
    layout = _layout(booster, arrays, rows, kinds)
    partitions = max(min(spark.sparkContext.defaultParallelism, -(-rows // _ROWS_PER_TASK[0])), -(-rows // _ROWS_PER_TASK[1]))
    state, before = _blocks(arrays, layout, partitions).persist(StorageLevel.MEMORY_AND_DISK_DESER), None
    trees, weights, kept, every = [], [], None, booster.getCheckpointInterval()
    for i in range(booster.getMaxIter()):
        if cut := every > 0 and i > 0 and i % every == 0:
            state.checkpoint()  # by the first job of the tree
        tree = _tree(state, layout, booster, i)
        if before:
            before.unpersist()
        if cut:
            if kept:
                delete(spark, kept)
            kept = state.getCheckpointFile()
        weight = booster.getStepSize() if i else 1.0
        trees.append(tree)
        weights.append(weight)
        levels = _questions(tree, layout)
        before, state = state, _grown(state, levels, _lowest(tree, len(levels), weight)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    before.unpersist()
    if kept:
        delete(spark, kept)
    return _model(spark, booster, trees, weights, layout)


def fit_boosting(booster: GBTClassifier, prepared: DataFrame, rows: int, *, sampled: bool = False) -> GBTClassificationModel:
    """``booster`` fitted to ``prepared``, which has ``rows`` rows.

    From ``BLOCKS_FROM`` rows on, its trees are grown in blocks: the same rounds, bins, cuts and leaves over all rows, up
    to the order of summation and the sample that thresholds come from. A booster that samples rows for each tree, or a share
    of the features for each node, is grown so only if ``sampled`` is given, as it draws other ones than the classifier does;
    else it stays with the classifier, like other subset strategies, weights, a validation column, vectors of unknown or more
    than ``WIDEST_DENSE`` features and trees deeper than 8.
    """
    kinds = _kinds(prepared, booster.getFeaturesCol())
    whole = booster.getSubsamplingRate() == 1.0 and booster.getFeatureSubsetStrategy() in ("all", "auto")
    plain = (
        (whole or sampled and _per_node(booster.getFeatureSubsetStrategy(), 1) is not None)
        and not booster.isSet(booster.weightCol) and not booster.isSet(booster.validationIndicatorCol)
        and booster.getMinWeightFractionPerNode() == 0.0 and 1 <= booster.getMaxDepth() <= 8
    )
    if rows < BLOCKS_FROM or not plain or kinds is None or not 0 < kinds[0] <= WIDEST_DENSE:
        return booster.fit(prepared)
    return _in_blocks(booster, prepared, rows, kinds)
