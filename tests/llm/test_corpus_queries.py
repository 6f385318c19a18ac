import hashlib
import zlib

import numpy as np
import pytest
from compare import connect, difference

import __spark_entry__ as entry_module
import corpus_pipeline
from odd import documents, rows
from scorewright.llm.oracle import ORACLE
from scorewright.llm.packing import END
from scorewright.llm.pii import KINDS, base_spans
from scorewright.llm.quality import features, fit
from scorewright.llm.queries import QUERIES
from scorewright.storage import materialize
from test_near_documents import slow as slow_groups
from test_passages import slow as slow_passages
from test_tokens import byte_library


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) is None


def test_all_are_registered():
    names = set(entry_module.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_queries_without_sql_give_a_row_per_document(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op1_pii", "op4_quality", "op7_token_counts", "op8_repeated_passages", "op10_bpe"):
        assert QUERIES[name](spark, sf).count() == n


def test_stages_keep_the_columns(spark, sf):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.schema.simpleString() == docs.schema.simpleString()
        empty = stage(spark, documents(spark, []), sf)
        assert empty.count() == 0


def test_near_duplicates_leave_one(spark, sf):
    kept = corpus_pipeline.keep_one_of_each_group(spark, documents(spark), sf).collect()
    ids = sorted(r.doc_id for r in kept if r.doc_id is not None)
    assert 8 in ids and 9 not in ids and 10 not in ids and 12 not in ids and ids.count(8) == 1
    assert {r.doc_id for r in kept} >= {0, 1, 2, 3, 4, 5, 6, 7, 8, 11, 13, 14, 15, 16}
    assert sum(r.doc_id is None for r in kept) == sum(r[0] is None for r in rows())


def test_pipeline(spark, sf):
    pieces = corpus_pipeline.run(spark, sf)
    assert pieces.columns[:4] == ["doc_id", "start", "length", "ids_crc32"] and pieces.count() > 0


def test_each_stage_against_brute_force(spark, sf):
    """Every stage's output from its own input, recomputed in plain Python."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    given = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = materialize(stage(spark, docs, sf))
        given[name] = before, docs.collect()
    assert names == ["quality", "near_duplicates", "repeated_passages", "personal_data", "packing"]

    before, after = given["quality"]
    model = fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    good = {k for k, r in before.items() if model.scores(features([r.text or ""]))[0] >= 0.3}
    assert {r.doc_id for r in after} == good and all(r == before[r.doc_id] for r in after)

    before, after = given["near_duplicates"]
    alone = {k for k, _, low in slow_groups([(k, r.text) for k, r in before.items()]) if k == low}
    assert {r.doc_id for r in after} == alone and all(r == before[r.doc_id] for r in after)

    before, after = given["repeated_passages"]
    removed = {k: (n, digest) for k, _, n, _, digest in slow_passages([(k, r.text) for k, r in before.items()])}
    assert {r.doc_id for r in after} == set(before)
    for r in after:
        n, digest = removed[r.doc_id]
        if before[r.doc_id].text.isascii():
            assert hashlib.sha256(r.text.encode()).hexdigest() == digest
        assert n > 0 or r.text == before[r.doc_id].text
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)

    before, after = given["personal_data"]
    for r in after:
        spans = sorted(((a, b, KINDS[k]) for k, a, b in base_spans(before[r.doc_id].text)), key=lambda s: (s[0], -s[1]))
        text, done = "", 0
        for a, b, kind in spans:
            if a >= done:
                text += before[r.doc_id].text[done:a] + f"<{kind}>"
            done = max(done, b)
        text += before[r.doc_id].text[done:]
        assert r.text == text or len(r.text) < len(text)  # the method may find more

    before, after = given["packing"]
    tokens = {k: [*byte_library.encode(r.text, add_special_tokens=False).ids, END] for k, r in before.items()}
    for r in after:
        assert r.ids_crc32 == zlib.crc32(np.array(tokens[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in after) == sum(map(len, tokens.values()))
