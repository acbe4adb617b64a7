"""Exact top-k search against all pairs in plain integers."""

import math
import random

import numpy as np
import pytest

from riskmart.llm import vectors


def slow(rows, k=5, every=50):
    ok = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in ok:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = set()
    for q, a in asked.items():
        found = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -2 ** 63), 2 ** 63 - 1), i) for i, b in ok if i != q)
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(found[:k], 1)}
    return out


def made(seed=5):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(20)]) for i in range(-150, 260)]
    rows += [(1000 + i, [0.25] * 20) for i in range(300)]  # one common vector
    rows += [(50, [0.25] * 20), (50, [0.25] * 20), (100, [0.1] * 3), (7, []), (150, [1.0] * 45), (8, [1.0] * 45)]
    rows += [(9, None), (None, [0.5] * 20), (10, [0.1, None]), (200, [float("nan")] * 20), (250, [float("inf"), 0.0]), (11, [3e38, 1.0]), (300, [2e17, -1.0]), (12, [1e9] * 20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"CHUNK": 7, "PACK_QUERIES": 3, "PART_ROWS": 50, "PRIME": 2, "SPARSE": 1.1}, {"CHUNK": 64, "SPARSE": 0.0}])
def test_all_pairs(spark, sizes, monkeypatch):
    for name, value in sizes.items():
        monkeypatch.setattr(vectors, name, value)
    rows = made()
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<double>, score int, query_id int, v int").repartition(3)
    got = [tuple(r) for r in vectors.top_k(df).collect()]
    assert len(got) == len({(q, n) for q, n, _, _ in got})
    assert set(got) == slow(rows)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert vectors.top_k(spark.createDataFrame([], schema)).collect() == []
    assert vectors.top_k(spark.createDataFrame([(50, [1.0])], schema)).collect() == []
    two = vectors.top_k(spark.createDataFrame([(0, [1.0, 2.0]), (3, [0.5, 0.5])], schema)).collect()
    assert [tuple(r) for r in two] == [(0, 1, 3, 256 * 128 + 512 * 128)]


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(1)
    a, b = (np.floor(256 * rng.normal(0, 0.3, (50, 37))) for _ in range(2))
    true = a @ b.T
    bounds = [x @ y.T for x, y in zip(vectors.Described(a).levels, vectors.Described(b).levels)]
    assert all((bound >= true - 1e-6).all() for bound in bounds)
    assert all((fine <= coarse + 1e-6).all() for coarse, fine in zip(bounds, bounds[1:]))
