"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches
from scorewright.storage import materialize_shuffled


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest index of each index's component, for links ``u[i] - v[i]`` between indices below n."""
    root = np.arange(n)
    while len(u):
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while not np.array_equal(jumped := root[root], root):
            root = jumped
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
        if (root == before).all():
            break
    return root


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Links of each batch as one link per node to the smallest node of its part."""
    for batch in batches:
        a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
        names, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = roots(len(names), index[: len(a)], index[len(a) :])
        own = np.flatnonzero(root != np.arange(len(names)))
        yield {"a": names[own], "b": names[root[own]]}


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node in ``links`` of longs ``a, b``.

    Nodes hook to their smallest neighbour, chains of hooks are halved until all point to a root, and links
    between roots remain; the roots at least halve each round. Tables are cut from their lineage in the
    shared folder; hot nodes fold in map-side aggregation and are split by adaptive skew joins. A link of a
    node with itself gives the node; null ends are left out; without links the result is empty.
    """
    some = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null")
    nodes = some.where("a = b").select(F.col("a").alias("node")).distinct()
    edges = materialize_shuffled(map_batches(some.where("a <> b"), _forests, "a long, b long").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize_shuffled(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("parent")))
        while True:
            above = parent.where("node <> parent").select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
            jumped = parent.join(above, "parent", "left").select("node", F.coalesce("grand", "parent").alias("parent"), F.col("grand").isNotNull().alias("moved"))
            jumped = materialize_shuffled(jumped)
            parent = jumped.select("node", "parent")
            if jumped.where("moved").isEmpty():
                break
        steps.append(parent)
        high = parent.select(F.col("node").alias("a"), F.col("parent").alias("x"))
        low = parent.select(F.col("node").alias("b"), F.col("parent").alias("y"))
        edges = materialize_shuffled(edges.join(high, "a").join(low, "b").where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    if not steps:
        return nodes.select("node", F.col("node").alias("component"))
    found = steps[0].select("node", F.col("parent").alias("component"))
    for step in steps[1:]:
        found = found.join(step.select(F.col("node").alias("component"), "parent"), "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
    lonely = nodes.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    return materialize_shuffled(found.unionByName(lonely))
