"""Near-duplicate vectors of equal label, by int8 tile products with exact error bounds.

A unit vector x is scale * q + r with q in int8. The product of two such vectors differs from the integer
product of their q by at most |scale q| |r'| + |r| |scale' q'| + |r| |r'|, which is known for every pair. Only
pairs whose bound straddles the threshold are computed again in double precision. A tile of two blocks
reports per vector its number of links and the smallest vector of its part: never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches
from scorewright.llm.components import components, roots
from scorewright.llm.vectors import finite, matrix, one_by_one, per_group
from scorewright.storage import materialize

#: Vectors of a block, cosine of a link, and pairs recomputed at once.
BLOCK, NEAR, AGAIN = 2048, 0.93, 1 << 16


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the lengths of the scaled rows, and the lengths of what is left."""
    scale = np.abs(x).max(axis=1, keepdims=True) / 127
    q = np.rint(x / scale).astype(np.int8)
    back = q * scale
    slack = 1e-12  # rounding of these sums themselves
    return q, scale[:, 0], np.sqrt((back**2).sum(1)) + slack, np.sqrt(((x - back) ** 2).sum(1)) + slack


def _unit(data: bytes, dim: int) -> np.ndarray:
    x = np.frombuffer(data, "<f8").reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def linked(x: np.ndarray, y: np.ndarray, near: float) -> np.ndarray:
    """Which rows of the unit vectors ``x`` and ``y`` have a cosine of at least ``near``."""
    (qx, sx, ax, rx), (qy, sy, ay, ry) = quantised(x), quantised(y)
    exact = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64  # integers below 2**24 are exact
    product = qx.astype(exact) @ qy.astype(exact).T * sx[:, None] * sy[None, :]
    error = ax[:, None] * ry[None, :] + rx[:, None] * (ay + ry)[None, :] + 1e-6
    links = product - error >= near
    i, j = np.nonzero((product + error >= near) & ~links)
    for at in range(0, len(i), AGAIN):
        a, b = i[at : at + AGAIN], j[at : at + AGAIN]
        links[a, b] = np.einsum("ij,ij->i", x[a], y[b]) >= near
    return links


def _packed(table: pa.Table) -> dict:
    first = table.slice(0, 1)
    return {c: first.column(c).to_pylist() for c in ("label", "dim", "block")} | {
        "ids": [table.column("cid").to_pylist()], "copies": [table.column("copies").to_pylist()], "data": [matrix(table, "embedding").astype("<f8").tobytes()],
    }


def _tiles(near: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in one_by_one(batches):
            x, y = _unit(row["data"], row["dim"]), _unit(row["other_data"], row["dim"])
            links = linked(x, y, near)
            if row["block"] == row["other"]:
                np.fill_diagonal(links, False)
            i, j = np.nonzero(links)
            if not len(i):
                continue
            ids, others = np.array(row["ids"]), np.array(row["other_ids"])
            names, index = np.unique(np.concatenate([ids, others]), return_inverse=True)
            root = names[roots(len(names), index[i], index[len(ids) + j])]
            count = np.zeros(len(names), np.int64)
            np.add.at(count, index[i], np.array(row["other_copies"])[j])
            if row["block"] != row["other"]:
                np.add.at(count, index[len(ids) + j], np.array(row["copies"])[i])
            own = np.flatnonzero(count)
            yield {"cid": names[own], "n": count[own], "root": root[own]}

    return work


def near_vectors(embeddings: DataFrame, *, near: float = NEAR, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Equal vectors of a label are one class while tiles are computed, so copies cost nothing; every other link
    counts. Vectors that are null, empty or zero or hold null or non-finite numbers, and those without label,
    link with nothing; so do vectors of different lengths. A row without an id has a null component and is
    not kept. Repeated rows are vectors of their own that link with each other. An empty table gives no rows;
    other columns are not read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), "embedding", "label")
    usable = finite("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.exists("embedding", lambda x: x != 0)
    classes = materialize(
        rows.where(usable).groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
        .select("*", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("cid"))
    )
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = classes.join(sizes, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    label = classes.schema["label"].dataType.simpleString()
    packed = per_group(blocks.select("label", "dim", "block", "cid", "copies", "embedding"), ["label", "dim", "block"], _packed, f"label {label}, dim int, block int, ids array<long>, copies array<long>, data binary")
    packed = materialize(packed.join(sizes, ["label", "dim"]))
    left = packed.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1))).drop("blocks")
    right = packed.select("label", "dim", F.col("block").alias("other"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("block"), F.col("ids").alias("other_ids"), F.col("copies").alias("other_copies"), F.col("data").alias("other_data"))
    reports = materialize(map_batches(left.join(right, ["label", "dim", "block", "other"]), _tiles(near), "cid long, n long, root long"))
    groups = components(reports.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    counted = reports.groupBy("cid").agg(F.sum("n").alias("n"))
    found = classes.join(counted, "cid", "left").join(groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = found.groupBy("component").agg(F.min("low").alias("component_id"))
    found = found.join(smallest, "component").select("label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    return (
        rows.withColumn("known", usable).alias("r")
        .join(found.alias("f"), F.expr("r.known and r.label = f.label and r.embedding = f.embedding"), "left")
        .select("r.vec_id", F.coalesce("f.n_links", F.lit(0)).alias("n_links"), F.coalesce("f.component_id", "r.vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
