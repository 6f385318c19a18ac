import random

import pytest
from odd import PASSAGE, documents
from pyspark.sql import functions as F

from scorewright.llm import near_documents, repeated_passages
from scorewright.llm.components import components
from scorewright.storage import TASKS, TOGETHER, materialize, materialize_shuffled

PARTITIONS = 320


@pytest.fixture
def many_partitions(spark):
    """A session that does not join small shuffle partitions by itself; gives the most files that a table may have."""
    conf = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield max(PARTITIONS // TOGETHER, TASKS * spark.sparkContext.defaultParallelism)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_partitions_share_files(spark, many_partitions):
    df = spark.range(5000).groupBy((F.col("id") % 2000).alias("k")).agg(F.count("*").alias("n"))
    done = materialize_shuffled(df.withColumn("id", F.monotonically_increasing_id()))
    assert len(done.inputFiles()) <= many_partitions < len(materialize(df).inputFiles())
    assert sorted((r.k, r.n) for r in done.collect()) == [(k, 3 if k < 1000 else 2) for k in range(2000)]
    assert done.select("id").distinct().count() == 2000


def test_components_write_few_files(spark, many_partitions):
    names = list(range(3000))
    random.Random(1).shuffle(names)
    pairs = [(a, b) for a, b in zip(names, names[1:], strict=False) if a % 3 or b % 3]
    found = components(spark.createDataFrame(pairs, "a long, b long").repartition(8))
    assert len(found.inputFiles()) <= many_partitions
    slow: dict[int, int] = {}
    chain: list[int] = []
    for a, b in [*pairs, (None, None)]:  # links follow a line of nodes
        if chain and chain[-1] != a:
            slow |= dict.fromkeys(chain, min(chain))
            chain = []
        chain = [*(chain or [a]), b]
    assert dict(map(tuple, found.collect())) == slow


def test_documents_write_few_files(spark, many_partitions, monkeypatch):
    files = []

    def counted(df):
        done = materialize_shuffled(df)
        files.append(len(done.inputFiles()))
        return done

    draw = random.Random(2)
    prose = lambda n: " ".join(str(draw.randrange(10**6)) for _ in range(n))
    first = prose(60)
    rows = [(i, prose(80) + " " + PASSAGE + " " + prose(5)) for i in range(150)] + [(i, first + f" {i}") for i in range(150, 170)]
    df = spark.createDataFrame([(k, t, *[None] * 10) for k, t in rows], documents(spark, []).schema).repartition(4)
    for module in (near_documents, repeated_passages):
        monkeypatch.setattr(module, "materialize_shuffled", counted)
    near = {r.doc_id: r.component_id for r in near_documents.near_documents(df).collect()}
    assert near == {i: min(i, 150) for i in range(170)}
    removed = {r.doc_id: r.n_removed for r in repeated_passages.remove_repeated(df).collect()}
    assert all(removed[i] >= len(PASSAGE) for i in range(150)) and all(removed[i] >= len(first) for i in range(150, 170))
    assert len(files) > 10 and max(files) <= many_partitions
