import math
import random

import pytest

from chronodim.llm import topk


def brute(rows, every, k):
    def fit(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)
    vecs = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and fit(v)]
    out = []
    for at, (q, mine) in enumerate(vecs):
        if q % every:
            continue
        best = sorted((-sum(a * b for a, b in zip(mine, v)), i) for j, (i, v) in enumerate(vecs) if j != at)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 900])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(37)]) for i in range(300)]
    rows += [(400 + i, rows[17][1]) for i in range(20)] + [(500 + i, [0.25] * 37) for i in range(30)]  # ties
    rows += [(17, rows[17][1]), (600, None), (601, [1.0, None]), (602, [float("nan")] * 37), (603, [float("inf")] * 37), (None, [9.0] * 37), (604, [2.0, 2.0]), (650, []), (100, rows[0][1]), (100, rows[100][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    out = topk.top_k(df, every=50, k=5, block_bytes=block_bytes)
    assert out.groupBy("query_row").count().count() == len([i for i, v in rows if i is not None and i % 50 == 0 and v is not None])
    got = sorted(tuple(r) for r in out.drop("query_row").collect())
    assert got == sorted(brute(rows, 50, 5))


def test_bounds_drop_pairs():
    import numpy as np

    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 64)) * 50
    x = np.floor(centres[rng.integers(0, 8, 4000)] + rng.normal(size=(4000, 64)))
    s = topk.Search(np.arange(8), x[:8], 5)
    for at in range(0, 4000, 500):
        s.add(np.arange(at, at + 500), x[at:at + 500])
    assert s.finished < 0.5 * s.compared


def test_large_components_small_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1e9, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(df).drop("query_row").collect()] == [(0, 1, 1, (256 * 10**9) ** 2 % 2**64 + 256 * 512 if (256 * 10**9) ** 2 < 2**63 else topk_wrap())]
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.limit(1)).count() == 0


def topk_wrap():
    v = ((256 * 10**9) ** 2 + 256 * 512) % 2**64
    return v - 2**64 if v >= 2**63 else v
