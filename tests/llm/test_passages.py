import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyspark.cloudpickle as cloudpickle
import pytest
from odd import PASSAGE, documents, prose

from scorewright.llm import repeated_passages as module
from scorewright.llm.anchors import LENGTH, roll, runs
from scorewright.llm.repeated_passages import IndexFamily, merged, remove_repeated, suffix_array


def slow(rows):
    seen = Counter()
    raw = [(k, (t or "").encode()) for k, t in rows]
    for _, b in raw:
        seen.update(b[i : i + 200] for i in range(len(b) - 199))
    out = []
    for k, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, **options):
    df = spark.createDataFrame([(k, t, *[None] * 10) for k, t in rows], documents(spark, []).schema).repartition(4)
    found = sorted(map(tuple, remove_repeated(df, **options).collect()), key=repr)
    assert found == slow(rows)


def test_odd_documents(spark):
    check(spark, [(r.doc_id, r.text) for r in documents(spark).collect()])
    assert remove_repeated(documents(spark, [])).count() == 0


@pytest.fixture
def by_value():
    """Tasks get the module as it stands here, with its patched sizes."""
    cloudpickle.register_pickle_by_value(module)
    yield
    cloudpickle.unregister_pickle_by_value(module)


@pytest.mark.parametrize("together, batches, piece, classes", [(512, 1, 1 << 20, 1 << 11), (2, 5, 1 << 20, 1 << 11), (8, 2, 250, 3)])
def test_passages_of_many_lengths(spark, monkeypatch, by_value, together, batches, piece, classes):
    for name, value in (("TOGETHER", together), ("PIECE", piece), ("CLASSES", classes)):
        monkeypatch.setattr(module, name, value)
    rows = [(i, prose(50 + i, 40) + " " + PASSAGE[i : i + 180 + 3 * i] + " " + prose(90 + i, 30)) for i in range(25)]
    rows += [(100 + i, PASSAGE[: 198 + i]) for i in range(5)]
    rows += [(200, "ab" * 150), (201, "ab" * 120), (202, "a" * 500), (203, "xyz" * 100 + prose(1, 50)), (204, "é" * 250), (205, (prose(77, 40) + "\n") * 5)]
    rows += [(300, "tail " + PASSAGE), (301, PASSAGE + " head")]
    check(spark, rows, batches=batches)


def test_runs_cover_every_start_once():
    raw = [prose(1, 200).encode(), b"a" * 450, b"short", prose(2, 60).encode()]
    rolling = roll(raw)
    found = runs(rolling)
    covered = Counter()
    for r, a, b, e in zip(found.row, found.anchor, found.back, found.ahead, strict=True):
        for start in range(a - b, a + e + 1):
            covered[r, start] += 1
    wanted = {(r, i) for r, text in enumerate(raw) for i in range(len(text) - LENGTH + 1)}
    assert set(covered) == wanted and set(covered.values()) == {1}


def test_levels_double(spark):
    family = IndexFamily()
    for i in range(5):
        family.add(suffix_array(spark.createDataFrame([(i,), (100 + i // 2,)], "head long")))
    assert sorted(family.levels) == [0, 2]  # five batches: one, and four as one
    assert sorted(r.head for r in family.matched().collect()) == [100, 101]


def test_kept_text_loses_broken_characters_only(spark):
    rows = [(1, "ä" * 130 + "one"), (2, "x" + "ä" * 130 + "two"), (3, "clean")]
    kept = {r.doc_id: r.kept for r in remove_repeated(documents(spark, [(*r, *[None] * 10) for r in rows]), digest=False).collect()}
    assert kept == {1: "one", 2: "xtwo", 3: "clean"}


def test_merged_spans():
    spans = [{"low": 5, "high": 9}, {"low": 0, "high": 3}, {"low": 3, "high": 4}, {"low": 6, "high": 7}]
    assert merged(spans) == [(0, 4), (5, 9)]


def test_only_some_classes_are_laid_out_at_once(monkeypatch):
    """Many small heads and one large one: what is held at once follows ``CLASSES``, and the result does not."""
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 256, 4000, dtype=np.uint8).tobytes()
    heads = sorted([*rng.integers(0, 60, 150).tolist(), *[99] * 90])
    raw = [rng.integers(0, 256, 15 * (k % 2), dtype=np.uint8).tobytes() + pool[a + 15 * (k % 2) : a + 260] for k, a in enumerate((300 * rng.integers(0, 12, len(heads))).tolist())]
    table = pa.table({
        "head": pa.array(heads, pa.int64()), "id": pa.array(range(len(heads)), pa.int64()), "n": pa.array([1] * len(heads), pa.int64()),
        "back": pa.array([30] * len(heads), pa.int16()), "bytes": pa.array(raw, pa.binary()),
    })
    seen = Counter((h, i, b[i : i + 200]) for h, b in zip(heads, raw) for i in range(61))
    want = {}
    for k, (h, b) in enumerate(zip(heads, raw)):
        if again := [i for i in range(61) if seen[h, i, b[i : i + 200]] > 1]:
            want[k] = {x for i in again for x in range(i - 30, i + 170)}
    sizes, strings = [], module._strings
    monkeypatch.setattr(module, "_strings", lambda t: sizes.append(len(t["bytes"])) or strings(t))
    monkeypatch.setattr(module, "CLASSES", 20)
    found = [x for d in module._compare_sorted(iter(table.to_batches(70))) for x in zip(d["id"], d["spans"])]
    assert {int(k): {x for s in spans for x in range(s["low"], s["high"])} for k, spans in found} == want
    assert len(found) == len(want) > 50 and len({min(w) for w in want.values()}) > 1
    assert max(sizes) <= 20 and sum(sizes) == len(heads)
