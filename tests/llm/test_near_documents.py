import random

import numpy as np
import pytest
from odd import documents, prose

from scorewright.llm import near_documents as module
from scorewright.llm.components import components, roots
from scorewright.llm.near_documents import choose_boundary, least_common, near_documents


def words_of(text):
    return bytes((text or "").encode()).lower().split()


def sets_of(rows):
    out = []
    for _, text in rows:
        w = words_of(text)
        out.append(set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    return out


def slow(rows):
    sets = sets_of(rows)
    u, v = [], []
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                u.append(i)
                v.append(j)
    root = roots(len(rows), np.array(u, int), np.array(v, int)).tolist()
    low = {}
    for (key, _), r in zip(rows, root, strict=True):
        if key is not None:
            low[r] = min(key, low.get(r, key))
    return sorted(((key, len(s), low.get(r, key)) for (key, _), s, r in zip(rows, sets, root, strict=True)), key=repr)


def check(spark, rows):
    df = spark.createDataFrame([(k, t, *[None] * 10) for k, t in rows], documents(spark, []).schema).repartition(5)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_documents(df).collect()), key=repr)
    assert found == slow(rows)


def test_odd_documents(spark):
    check(spark, [(r.doc_id, r.text) for r in documents(spark).collect()])
    assert near_documents(documents(spark, [])).count() == 0


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("often", [3, 10**9])
def test_groups_chains_and_shared_passages(spark, monkeypatch, often):
    """Copies with edits around the threshold, chains, common passages, small sets of every size."""
    monkeypatch.setattr(module, "OFTEN", often)
    rng = random.Random(7)
    rows = []
    base = prose(11, 120).split()
    rows += [(len(rows) + i, edited(rng, base, i % 6)) for i in range(60)]
    chain = prose(12, 90).split()
    for i in range(25):
        chain = edited(rng, chain, 1).split()
        rows.append((len(rows), " ".join(chain)))
    common = prose(13, 60)
    rows += [(len(rows) + i, common + " " + prose(200 + i, 8 + i)) for i in range(40)]
    for n in range(1, 30):
        own = [f"s{n}x{k}" for k in range(n)]
        rows += [(len(rows), " ".join(own)), (len(rows) + 1, " ".join(own + ["more"])), (len(rows) + 2, " ".join(own).upper())]
    rng.shuffle(rows)
    check(spark, rows)


def test_boundary_follows_cost():
    assert choose_boundary({}, 1.0) == 0
    assert choose_boundary({4: 10, 60: 10}, 0.0) < 60
    assert choose_boundary({4: 10, 60: 10}, 1000.0) == 60
    assert [least_common(n) for n in (1, 4, 5, 10, 11)] == [1, 4, 4, 8, 9]


@pytest.mark.parametrize("links", [[], [(1, 1)], [(5, 3), (3, 9), (7, 7), (None, 2)], [(i, i + 1) for i in range(200)], [(i, 999) for i in range(300)] + [(999, 998)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long").repartition(4)
    names = sorted({x for a, b in links if a is not None and b is not None for x in (a, b)})
    place = {x: i for i, x in enumerate(names)}
    kept = [(a, b) for a, b in links if a is not None and b is not None]
    root = roots(len(names), np.array([place[a] for a, _ in kept], int), np.array([place[b] for _, b in kept], int))
    assert {(r.node, r.component) for r in components(df).collect()} == {(x, names[root[place[x]]]) for x in names}
