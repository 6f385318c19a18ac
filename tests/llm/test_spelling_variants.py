"""Counts, neighbours and forms against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from odd import documents, rows
from scorewright.llm import spelling_variants as module
from scorewright.llm.pieces import lay_out
from scorewright.llm.queries import QUERIES
from scorewright.llm.spelling_variants import checksums, near_words, spelling_variants, word_counts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def slow_counts(rows, shortest=6, least=5):
    counts = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def slow_near(counts):
    alphabet = {c for w in counts for c in w}
    near = {}
    for w in counts:
        own = {w[:i] + w[i + 1 :] for i in range(len(w))}
        own |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        own |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet}
        near[w] = (own & counts.keys()) - {w}
    return near


def slow_variants(counts, ratio=5):
    near = slow_near(counts)
    best = {w: min(own, key=lambda v: (-counts[v], v)) for w, own in near.items() if own}
    form = {w: v for w, v in best.items() if counts[v] >= ratio * counts[w]}
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), st.text("azÀÿ÷×é", min_size=1, max_size=90)), min_size=1, max_size=30))
def test_checksums(runs):
    layout = lay_out([r for _, r in runs])
    sizes = np.diff(layout.bounds)
    found = checksums(np.array([p for p, _ in runs], np.uint32), layout.codes, layout.bounds[:-1], sizes)
    assert found.tolist() == [zlib.crc32(r.encode(), p) for p, r in runs]


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)


def vocabulary(seed, n, letters="abcdeéÿ", low=6, high=9):
    """Words with many neighbours: a few stems, changed once or twice."""
    random.seed(seed)
    stems = ["".join(random.choice(letters) for _ in range(random.randint(low, high))) for _ in range(n // 20)]
    made = {}
    for _ in range(n):
        w = random.choice(stems)
        for _ in range(random.randint(0, 2)):
            i, c = random.randrange(len(w) + 1), random.choice(letters)
            w = random.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])
        if len(w) >= low:
            made[w] = random.choice([5, 6, 30, 31, 200, 200, 5000])
    return made


@pytest.mark.parametrize("seed,shortest,letters", [(1, 6, "abcdeéÿ"), (2, 6, "ab"), (3, 3, "abc"), (4, 1, "ab")])
def test_neighbours_and_forms(spark, seed, shortest, letters):
    counts = vocabulary(seed, 400, letters, low=shortest, high=shortest + 3)
    pairs = near_words(frame(spark, counts), shortest=shortest)
    found = sorted((r.word, r.near, r.n) for r in pairs.collect())
    assert found == sorted((w, v, counts[v]) for w, own in slow_near(counts).items() for v in own)
    assert sorted(map(tuple, spelling_variants(frame(spark, counts), shortest=shortest).collect())) == slow_variants(counts)


def test_runs_of_one_letter_and_long_words(spark):
    """Equal letters around an edit, words that begin other words, chains, and words of thousands of letters."""
    random.seed(5)
    long = "".join(random.choice("abcdefgh") for _ in range(5000))
    counts = {"a" * k: 5**k for k in range(6, 14)}
    counts |= {"aaabaaa": 5, "aaabaa": 25, "aaabbaaa": 7, "abcabc": 9, "abcabcabc": 9, "abcabca": 50, long: 5, long[:2500] + "x" + long[2500:]: 30, long[1:]: 200, long[:-1]: 1000, long + "é": 5}
    assert sorted(map(tuple, spelling_variants(frame(spark, counts)).collect())) == slow_variants(counts)


def test_ties_and_limits(spark):
    counts = {"wordaa": 5, "wordab": 25, "wordac": 25, "wordad": 24, "wordxx": 5, "wordxxx": 24}
    found = {r.word: r for r in spelling_variants(frame(spark, counts)).collect()}
    assert (found["wordaa"].form, found["wordaa"].n_near, found["wordaa"].form_n) == ("wordab", 3, 25)
    assert found["wordxx"].form is None and found["wordxx"].n_near == 1 and found["wordxx"].root == "wordxx"
    with pytest.raises(ValueError):
        spelling_variants(frame(spark, counts), ratio=1)


@pytest.mark.parametrize("sent", [0, 1 << 30])
def test_only_small_levels_are_sent_to_all_tasks(spark, monkeypatch, sent):
    """Spark would send any table that it takes to be small, such as the prefixes of all words."""
    counts, plans, levels = vocabulary(6, 300), [], []
    keep, plan = module.materialize, lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(module, "materialize", lambda df: (levels if "goes_on" in df.columns else plans).append(plan(df)) or keep(df))
    monkeypatch.setattr(module, "SENT", sent)
    found = spelling_variants(frame(spark, counts))
    assert sorted(map(tuple, found.collect())) == slow_variants(counts)
    kinds = [("BroadcastHashJoin" in p, "SortMergeJoin" in p) for p in levels]
    assert len(kinds) > 1 and kinds == [(False, True)] + [(sent > 0, sent == 0)] * (len(kinds) - 1)
    plans = [p for p in [*plans, plan(found)] if "Join" in p]
    assert len(plans) > 3 and not any("BroadcastHashJoin" in p for p in plans)


def test_odd_documents(spark):
    own = [(r[0], r[1]) for r in rows()] + [(50, "Ärger ÄRGER×÷ Straße " * 40), (51, "a" * 100_000 + " " + "Xyzzyx" * 30), (None, "plover plover' plover-plover " * 30)] + [(i, " ".join(f"quickly quxckly{c} dolphin" for c in "abc")) for i in range(100, 400)]
    df = documents(spark, [(i, t, *[None] * 10) for i, t in own])
    for shortest, least in ((6, 5), (2, 1)):
        counts = slow_counts(own, shortest, least)
        found = word_counts(df, shortest=shortest, least=least)
        assert sorted(map(tuple, found.collect())) == sorted(counts.items())
    assert sorted(map(tuple, spelling_variants(word_counts(df)).collect())) == slow_variants(slow_counts(own))
    assert spelling_variants(word_counts(documents(spark, []))).count() == 0


def test_query(spark, sf):
    own = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_spelling_variants"](spark, sf).collect())) == slow_variants(slow_counts(own))
