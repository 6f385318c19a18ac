import numpy as np
import pytest

from scorewright.llm import near_vectors as near_module
from scorewright.llm import topk as topk_module
from scorewright.llm.components import roots
from scorewright.llm.near_vectors import linked, near_vectors, quantised
from scorewright.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, block string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)


def odd_rows():
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8))], int(i % 3)) for i in range(150)]
    rows += [(200 + i, rows[i % 2][1], 0) for i in range(40)]  # many equal vectors, so many ties
    rows += [(300 + i, [float(np.float32(x * (1 + 0.02 * i))) for x in rows[5][1][:4]] + rows[5][1][4:], 2) for i in range(20)]
    rows += [(400, None, 0), (401, [1.0, None] * 4, 0), (450, [float("nan")] * 8, 0), (403, [float("inf")] + [0.0] * 7, 0), (404, [0.0] * 8, 0), (405, [], 1)]
    rows += [(406, rows[0][1], None), (None, rows[0][1], 0), (407, [1.0, 2.0], 0), (408, [1.0, 2.0], 0), rows[3], rows[3]]
    return rows


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("sizes", [(8192, 1024, 512), (16, 2, 4)])
def test_top_k_against_sorting(spark, monkeypatch, sizes):
    for name, value in zip(("CANDIDATES", "QUERIES", "BINS"), sizes, strict=True):
        monkeypatch.setattr(topk_module, name, value)
    if sizes[2] != 512:
        import pyspark.cloudpickle as cloudpickle

        cloudpickle.register_pickle_by_value(topk_module)  # tasks must see the small histogram
    try:
        found = sorted(map(tuple, top_k(frame(spark, odd_rows()), "vec_id % 50 = 0", 5).collect()))
    finally:
        if sizes[2] != 512:
            cloudpickle.unregister_pickle_by_value(topk_module)
    assert found == slow_top(odd_rows())


def slow_top(rows):
    """Every row but the query's own is a candidate; a repeated id asks with its smallest vector."""
    rows = [(k, v) for k, v, _ in rows if k is not None and usable(v)]
    scaled = [np.floor(256 * np.array(v, np.float64)).astype(int) for _, v in rows]
    wanted = []
    for q in {k for k, _ in rows if k % 50 == 0}:
        own = min((i for i, (k, _) in enumerate(rows) if k == q), key=lambda i: rows[i][1])
        scores = sorted((-int(scaled[own] @ v), k) for i, ((k, _), v) in enumerate(zip(rows, scaled, strict=True)) if i != own and len(v) == len(scaled[own]))
        wanted += [(q, i + 1, k, -s) for i, (s, k) in enumerate(scores[:5])]
    return sorted(wanted)


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    rows = [(1, [0.1], 0), (1, [0.9], 0), (2, [0.5], 0), (2, [0.5], 0), (2, [0.5], 0), (50, [1.0], 0), (50, [-1.0], 0), (50, [-1.0], 0), (100, [2.0], 0)]
    found = sorted(map(tuple, top_k(frame(spark, rows), "vec_id % 50 = 0", 5).collect()))
    assert found == slow_top(rows)
    assert (100, 2, 1, 230 * 512) in found and [r[2] for r in found if r[0] == 100] == [50, 1, 2, 2, 2]


def test_top_k_of_few_and_none(spark):
    assert top_k(frame(spark, []), "vec_id % 50 = 0", 5).count() == 0
    assert sorted(map(tuple, top_k(frame(spark, [(0, [1.0], 0), (3, [2.0], 0)]), "vec_id % 50 = 0", 5).collect())) == [(0, 1, 3, 131072)]
    assert top_k(frame(spark, [(0, [1.0], 0)]), "vec_id % 50 = 0", 5).count() == 0


def test_quantisation_bounds_are_rigorous():
    rng = np.random.default_rng(0)
    for dim in (1, 3, 64, 2000):
        x = rng.normal(size=(200, dim)) * rng.choice([1e-6, 1, 50], size=(200, 1))
        x /= np.sqrt((x**2).sum(1, keepdims=True))
        q, scale, length, rest = quantised(x)
        error = length[:, None] * rest[None, :] + rest[:, None] * (length + rest)[None, :]
        assert (np.abs(x @ x.T - (q * scale[:, None]) @ (q * scale[:, None]).T) <= error + 1e-9).all()
        near = linked(x, x, 0.3)
        exact = x @ x.T
        clear = np.abs(exact - 0.3) > 1e-12
        assert (near[clear] == (exact >= 0.3)[clear]).all()


@pytest.mark.parametrize("block", [2048, 8])
def test_near_vectors_against_all_pairs(spark, block):
    rows = odd_rows()
    found = sorted(map(tuple, near_vectors(frame(spark, rows), block=block).collect()), key=repr)
    u, v = [], []
    for i, (a, x, la) in enumerate(rows):
        for j, (b, y, lb) in enumerate(rows[:i]):
            if a is None or b is None or la is None or la != lb or not usable(x) or not usable(y) or len(x) != len(y) or not any(x) or not any(y):
                continue
            p, q = np.array(x, np.float64), np.array(y, np.float64)
            if p @ q / np.sqrt(p @ p) / np.sqrt(q @ q) >= near_module.NEAR:
                u.append(i)
                v.append(j)
    root = roots(len(rows), np.array(u), np.array(v))
    links = np.bincount(np.concatenate([u, v]).astype(int), minlength=len(rows))
    low = {}
    for (k, _, _), r in zip(rows, root.tolist(), strict=True):
        if k is not None:
            low[r] = min(k, low.get(r, k))
    wanted = [(k, int(n), low.get(r), k is not None and k == low.get(r)) for (k, _, _), n, r in zip(rows, links, root.tolist(), strict=True)]
    assert found == sorted(wanted, key=repr)


def test_no_vectors(spark):
    assert near_vectors(frame(spark, [])).count() == 0
