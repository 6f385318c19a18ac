import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scorewright.sources import digests


def slow(values, leaf=digests.LEAF):
    """The tree, node by node from the root."""
    counts = Counter(v or "" for v in values)
    if len(values) == 1:
        return values[0]
    depth = 0
    while len(counts) > leaf * 256**depth:
        depth += 1

    def node(prefix, below):
        if len(prefix) == 2 * depth:
            entries = [f"{d}:{n}" for d, n in sorted(below.items())]
        else:
            parts = sorted({d[: len(prefix) + 2] for d in below})
            entries = [node(p, {d: n for d, n in below.items() if d[: len(prefix) + 2] == p}) for p in parts]
        return hashlib.sha256(",".join(entries).encode()).hexdigest()

    return node("", counts)


def _digest(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


@pytest.mark.parametrize("leaf", [1, 3, 256])
@pytest.mark.parametrize("values", [[_digest(1)], [_digest(1)] * 2, [_digest(i % 700) for i in range(2000)], [_digest(1)] * 9000 + [_digest(2)], [None]])
def test_folded_digests(spark, values, leaf):
    df = spark.createDataFrame([(v,) for v in values], "sha256 string")
    assert digests.fold_digests(df, leaf).first().sha256 == slow(values, leaf)


def test_null_digests_are_empty_texts(spark):
    values = [_digest(1), None, None, _digest(2)]
    df = spark.createDataFrame([(v,) for v in values], "sha256 string")
    assert digests.fold_digests(df).first().sha256 == slow(values)


def test_no_digest(spark):
    assert digests.fold_digests(spark.createDataFrame([], "sha256 string")).first().sha256 == hashlib.sha256().hexdigest()


def test_any_change_shows(spark):
    def root(values):
        return digests.fold_digests(spark.createDataFrame([(v,) for v in values], "sha256 string"), 2).first().sha256

    values = [_digest(i) for i in range(40)]
    assert root(values) == root(values[::-1])
    assert len({root(values), root(values[1:]), root([*values, values[3]]), root([*values[1:], _digest(99)])}) == 4


def test_nodes_are_bounded(spark, monkeypatch):
    """200,000 rows, half of them copies of one text: no node holds more than a few hundred entries, and no Python runs."""
    largest, frames = [], []
    agg = type(spark.range(1).groupBy("id")).agg
    copies = F.when(F.col("id") % 2 == 0, F.lit("copy")).otherwise(F.col("id").cast("string"))
    df = spark.range(200_000).select(F.sha2(copies, 256).alias("sha256"))

    def spy(grouped, *columns):
        if "collect_list" in str(columns):
            largest.append(agg(grouped, F.count("*").alias("entries")).agg(F.max("entries")).first()[0])
        frames.append(agg(grouped, *columns))
        return frames[-1]

    monkeypatch.setattr(type(spark.range(1).groupBy("id")), "agg", spy)
    root = digests.fold_digests(df)
    monkeypatch.undo()
    assert len(largest) == 3 and max(largest) <= 300
    assert not any(word in root._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas"))
    assert root.first().sha256 == slow([r.sha256 for r in df.collect()])


def slow_pieces(content, piece):
    """Lines by where they begin, folded by 256."""
    lines, at, pieces = content.split(b"\n"), 0, {}
    if lines[-1] == b"":
        lines.pop()
    for line in lines:
        pieces.setdefault(at // piece, []).append(line)
        at += len(line) + 1
    nodes = {k: hashlib.sha256(b"".join(x + b"\n" for x in own)).hexdigest() for k, own in pieces.items()}
    while True:
        groups = {}
        for k in sorted(nodes):
            groups.setdefault(k // 256, []).append(nodes[k])
        nodes = {k: hashlib.sha256(",".join(own).encode()).hexdigest() for k, own in groups.items()}
        if list(nodes) == [0]:
            break
    return hashlib.sha256(f"{nodes[0]}:{str(at == len(content)).lower()}".encode()).hexdigest()


@pytest.mark.parametrize("split", ["128m", "9000"])
def test_files_over_the_limit_are_digested_in_pieces(spark, tmp_path, split):
    """However the files are split, with bytes that are no text, carriage returns, empty lines and no last line break."""
    lines = [b"row %d,\xff\xfe\x00 %s\r" % (i, b"x" * (i % 90)) for i in range(3000)] + [b"", b"", b"last"]
    contents = {"a.bin": b"\n".join(lines) + b"\n", "b.bin": b"\n".join(lines), "c/d.bin": b"\n".join(lines[:700]), "small": b"deterministic-model"}
    (tmp_path / "c").mkdir()
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = {r.file: (r.length, r.sha256) for r in digests.file_digests(spark, str(tmp_path), whole=1000, piece=256).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {name: hashlib.sha256(content).hexdigest() if len(content) <= 1000 else slow_pieces(content, 256) for name, content in contents.items()}
    assert {f: d for f, (_, d) in found.items()} == want and {f: n for f, (n, _) in found.items()} == {f: len(c) for f, c in contents.items()}
    assert len(set(want.values())) == 4
