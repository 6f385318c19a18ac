"""A fitted tree ensemble as a table of nodes, and scoring from it: a batch of rows at a time, or one tree as an expression.

This path shares nothing with the classifier that fitted the trees but what it saved, so the two check each
other. An ensemble has a bounded number of nodes (rounds times two to the depth), whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import sql_number

_VALUES = "_values"

# Features up to which making a row's vector dense costs less than walking its trees one by one.
WIDEST_DENSE = 1_000


def ensemble_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``tree, weight, node, left, right, feature, threshold, categories, prediction, rows`` of a saved pipeline's boosting.

    A row goes left if its feature's value is at most ``threshold``, or one of ``categories`` where these are
    given. Leaves have no children. ``rows`` is the number of training rows that met the node.
    """
    stage = f"{path}/stages/*_GBTClassifier_*"
    nodes = spark.read.parquet(f"{stage}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{stage}/treesMetadata").toDF("treeID", "_about", "weight")
    inner, several = F.col("leftChild") >= 0, F.col("split.numCategories") >= 0
    side = F.col("split.leftCategoriesOrThreshold")
    return nodes.join(weights, "treeID").select(
        F.col("treeID").alias("tree"), "weight", F.col("id").alias("node"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ~several, side[0]).alias("threshold"), F.when(inner & several, side).alias("categories"),
        "prediction", F.col("rawCount").alias("rows"),
    )


def tree_expressions(nodes: Sequence[Row], outcome: str) -> dict[int, str]:
    """SQL per tree over an array of feature values: ``outcome`` (a column of the nodes) of the leaf a row comes to."""
    found = {(n.tree, n.node): n for n in nodes}

    def choice(n: Row) -> str:
        if n.left is None:
            return sql_number(n[outcome])
        value = f"{_VALUES}[{n.feature}]"
        goes_left = f"{value} <= {sql_number(n.threshold)}" if n.categories is None else f"{value} in ({', '.join(map(sql_number, n.categories))})" if n.categories else "false"
        return f"if({goes_left}, {choice(found[n.tree, n.left])}, {choice(found[n.tree, n.right])})"

    return {tree: choice(found[tree, 0]) for tree in sorted({n.tree for n in nodes})}


def _with_values(prepared: DataFrame) -> DataFrame:
    return prepared.withColumn(_VALUES, vector_to_array("features"))


def _programs(rows: Sequence[Row]) -> tuple[list[tuple], list[tuple]]:
    """The distinct questions of an ensemble (feature, threshold, categories), and per tree its weight and its program.

    A program of a tree of at most 32 leaves is ``(steps, outcomes)``: leaves are bits from the left, and a question that
    is denied clears the bits of its node's left side (a step), so the lowest bit left over is the leaf a row comes to.
    A larger tree is ``(question, left, right)`` of two programs.
    """
    found = {(n.tree, n.node): n for n in rows}
    questions: dict[tuple, int] = {}

    def question(n: Row) -> int:
        return questions.setdefault((n.feature, n.threshold, None if n.categories is None else tuple(n.categories)), len(questions))

    def small(tree: int, node: int) -> tuple[list, list]:
        n = found[tree, node]
        if n.left is None:
            return [], [n.prediction]
        (left, outcomes), (right, others) = small(tree, n.left), small(tree, n.right)
        at = len(outcomes)
        cleared = [(question(n), (1 << at) - 1), *left, *((q, bits << at) for q, bits in right)]
        return cleared, outcomes + others

    def leaves(tree: int, node: int) -> int:
        n = found[tree, node]
        return 1 if n.left is None else leaves(tree, n.left) + leaves(tree, n.right)

    def program(tree: int, node: int) -> tuple:
        if leaves(tree, node) <= 32:
            return small(tree, node)
        n = found[tree, node]
        return question(n), program(tree, n.left), program(tree, n.right)

    trees = sorted({(n.tree, n.weight) for n in rows})
    programs = [(weight, program(tree, 0)) for tree, weight in trees]
    return list(questions), programs


def _margin(rows: Sequence[Row], asked: Sequence[int]) -> Callable:
    """A column function from arrays of the ``asked`` features to the weighted sum of all trees, for a block of rows at a time."""
    questions, programs = _programs(rows)
    questions = [(asked.index(f), threshold, categories) for f, threshold, categories in questions]

    @F.arrow_udf("double")
    def margin(batch: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        def outcome(program: tuple, yes: list):
            if len(program) == 3:
                q, left, right = program
                return np.where(yes[q], outcome(left, yes), outcome(right, yes))
            steps, outcomes = program
            kept = np.full(len(yes[0]) if yes else 1, 0xFFFFFFFF, np.uint32)
            keep = np.empty_like(kept)
            for q, bits in steps:
                np.bitwise_or(yes[q], np.uint32(0xFFFFFFFF ^ bits), out=keep)
                np.bitwise_and(kept, keep, out=kept)
            lowest = kept & (~kept + np.uint32(1))
            return np.asarray(outcomes)[(lowest.astype(np.float32).view(np.uint32) >> 23) - 127]  # the exponent is the bit's place

        totals = np.zeros(len(batch))
        for start in range(0, len(batch), 4096):
            block = batch.slice(start, 4096)
            x = np.ascontiguousarray(block.flatten().to_numpy(zero_copy_only=False).reshape(len(block), -1).T)
            # All bits where a question is affirmed, else none.
            yes = [
                np.where(x[f] <= threshold if categories is None else np.isin(x[f], categories), np.uint32(0xFFFFFFFF), np.uint32(0))
                for f, threshold, categories in questions
            ]
            for weight, program in programs:
                totals[start : start + len(block)] += outcome(program, yes) * weight
        return pa.array(totals)

    return margin


def ensemble_probability(prepared: DataFrame, nodes: DataFrame, p: str = "p") -> DataFrame:
    """``prepared`` (with ``features``) and the probability of class 1: the logistic of twice the weighted sum of trees.

    Only features that a node asks for reach the batches. Each row's vector is made dense once.
    """
    rows = nodes.collect()  # of one ensemble
    asked = sorted({n.feature for n in rows if n.feature is not None}) or [0]
    total = _margin(rows, asked)(F.array(*[F.col(_VALUES)[f] for f in asked]))
    return _with_values(prepared).withColumn(p, 1.0 / (1.0 + F.exp(-2.0 * total))).drop(_VALUES)


def leaf_table(prepared: DataFrame, nodes: DataFrame, label: str = "label", tree: int = 0) -> DataFrame:
    """``node, prediction, rows, seen, mean`` per leaf of one tree: what the fit kept, and the rows that come to it here.

    ``mean`` is that of labels as -1 and 1, which the first tree of a boosting on all rows predicts.
    """
    expression = tree_expressions(nodes.filter(F.col("tree") == tree).collect(), "node")[tree]
    met = _with_values(prepared).select(F.expr(expression).cast("int").alias("node"), (2.0 * F.col(label) - 1.0).alias("sign"))
    seen = met.groupBy("node").agg(F.count(F.lit(1)).alias("seen"), F.avg("sign").alias("mean"))
    leaves = nodes.filter((F.col("tree") == tree) & F.col("left").isNull())
    return leaves.select("node", "prediction", "rows").join(seen, "node", "left")
