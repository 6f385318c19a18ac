"""SHA-256 of files and of whole artifacts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import materialize


#: Bytes up to which a file is one value, and bytes of a piece of a longer one.
WHOLE, PIECE = 1 << 30, 1 << 20


def file_digests(spark: SparkSession, path: str, whole: int = WHOLE, piece: int = PIECE) -> DataFrame:
    """``file`` (relative to ``path``), ``length``, ``sha256`` for every file below ``path``.

    Files of over ``whole`` bytes are read as lines, in order and in pieces, and have :func:`piece_digests`.
    """
    root = re.sub("^[a-zA-Z0-9]+:/*", "/", path).rstrip("/")
    name = root.split("/")[-1]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    relative = F.regexp_extract("path", f"\\Q{root}\\E/?(.*)$", 1)
    relative = F.when(relative == "", F.lit(name)).otherwise(relative)
    # Only the listing is read where content is not asked for, and a length too long keeps a file from being read.
    digests = files.filter(F.col("length") <= whole).select("path", "length", F.sha2("content", 256).alias("sha256"))
    long = files.filter(F.col("length") > whole).select("path", "length")
    paths = [row.path for row in long.collect()]  # one for each ``whole`` bytes at most
    if paths:
        digests = digests.unionByName(piece_digests(spark, paths, piece).join(long, "path").select("path", "length", "sha256"))
    return digests.select(relative.alias("file"), "length", "sha256")


def piece_digests(spark: SparkSession, paths: list[str], piece: int = PIECE) -> DataFrame:
    """``path, sha256`` of files of any length: the digest of the digests of their pieces.

    A piece holds the lines that begin in the same ``piece`` bytes of the file, so pieces are the same however
    the file is split among tasks; the digest of a file without a last line break differs from one with it. A
    line must fit in memory. Pieces are folded in groups of 256 until one is left.
    """
    lines = spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("line"),
    )
    lines = materialize(lines.withColumn("bytes", F.octet_length("line") + F.lit(1).cast("long")))
    # A line is read with the block that it begins in, and a block's lines are read by one task in their order.
    blocks = lines.groupBy("path", "block").agg(F.sum("bytes").alias("bytes"), F.max("size").alias("size"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select("path", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("opening"))  # a row per block
    inside = Window.partitionBy("path", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    begins = lines.withColumn("inner", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(placed, ["path", "block"])
    pieces = begins.withColumn("node", F.expr(f"(opening + inner) div {piece}"))
    texts = "transform(array_sort(collect_list(struct(opening, inner, line))), x -> x.line)"
    joined = F.expr(f"aggregate({texts}, cast('' as binary), (a, x) -> concat(a, x, cast('\n' as binary)))")
    nodes = pieces.groupBy("path", "node").agg(F.sha2(joined, 256).alias("entry"))
    sizes = blocks.groupBy("path").agg((F.expr(f"sum(bytes) div {piece}") + 1).alias("left"))  # pieces, a row per file
    most = sizes.agg(F.max("left")).first()[0]
    nodes = nodes.join(sizes, "path")
    folded = F.sha2(F.expr("array_join(transform(array_sort(collect_list(struct(node, entry))), x -> x.entry), ',')"), 256)
    first = True
    while first or most > 1:  # a file that is one node already stays
        entry = folded if first else F.when(F.max("left") > 1, folded).otherwise(F.max("entry"))
        nodes = nodes.groupBy("path", F.expr("node div 256").alias("above")).agg(entry.alias("entry"), F.max(F.expr("(left + 255) div 256")).alias("left"))
        nodes, most, first = nodes.withColumnRenamed("above", "node"), -(-most // 256), False
    ended = blocks.groupBy("path").agg((F.sum("bytes") == F.max("size")).alias("ended"))  # whether the last line is
    return nodes.join(ended, "path").select("path", F.sha2(F.concat_ws(":", "entry", F.col("ended").cast("string")), 256).alias("sha256"))


def artifact_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``sha256``: the file's own digest, or for a folder the digest of its digests (see :func:`fold_digests`)."""
    return fold_digests(file_digests(spark, path))


#: Hex digits that a level of the tree divides by, and distinct digests that a leaf may have on average.
FAN_DIGITS, LEAF = 2, 256


def tree_depth(distinct: int, leaf: int = LEAF) -> int:
    """Levels above the leaves: the fewest with which leaves of evenly spread digests hold ``leaf`` on average."""
    depth = 0
    while distinct > leaf * 16 ** (FAN_DIGITS * depth):
        depth += 1
    return depth


def fold_digests(digests: DataFrame, leaf: int = LEAF) -> DataFrame:
    """One row, ``sha256``, of a table with that column: the root of a tree of bounded fan-in.

    Equal digests are counted first, so copies are one row. A leaf holds the digests that share a prefix, as
    sorted ``digest:count`` entries; a node holds up to 256 nodes whose prefixes begin with its own, in order.
    Depth follows the number of distinct digests, which are evenly spread, so no node grows with the table. A
    single digest stands for itself; a null one is an empty text; without rows it is the digest of nothing.
    """
    counted = materialize(digests.groupBy(F.coalesce("sha256", F.lit("")).alias("d")).agg(F.count(F.lit(1)).alias("n")))
    sizes = counted.agg(F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("rows")).first()
    if sizes.rows == 1:
        return counted.select(F.nullif("d", F.lit("")).alias("sha256"))
    nodes = counted.select(F.col("d").alias("prefix"), F.concat_ws(":", "d", F.col("n").cast("string")).alias("entry"))
    for depth in range(tree_depth(sizes.distinct, leaf), -1, -1):
        own = F.substring("prefix", 1, FAN_DIGITS * depth).alias("own") if depth else F.lit("").alias("own")
        entries = F.expr("array_join(transform(array_sort(collect_list(struct(prefix, entry))), x -> x.entry), ',')")
        nodes = nodes.groupBy(own).agg(F.sha2(entries, 256).alias("entry")).withColumnRenamed("own", "prefix")
    if not sizes.distinct:
        return digests.sparkSession.range(1).select(F.sha2(F.lit(""), 256).alias("sha256"))
    return nodes.select(F.col("entry").alias("sha256"))
