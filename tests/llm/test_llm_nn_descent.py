import math

import numpy as np
import pytest

from chronodim.llm import nn_descent


def brute(rows, threshold=0.95):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    rows = [(i, v) for i, v in rows if i is not None]
    dim = max((len(v) for _, v in rows if v), default=1)
    good = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    x = np.array([list(v) + [0.0] * (dim - len(v)) if ok else [0.0] * dim for (_, v), ok in zip(rows, good, strict=True)])
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    link = x @ x.T >= threshold
    np.fill_diagonal(link, False)
    root, out = [None] * len(rows), []
    for i in range(len(rows)):
        if root[i] is None:
            todo, found = [i], set()
            while todo:
                j = todo.pop()
                if j not in found:
                    found.add(j)
                    todo += np.flatnonzero(link[j]).tolist()
            least = min(rows[j][0] for j in found)
            for j in found:
                root[j] = least
        out.append((rows[i][0], int(link[i].sum()), root[i], root[i] == rows[i][0]))
    return sorted(out)


def near(rng, centre, spread):
    v = centre + rng.normal(size=centre.shape) * spread * np.linalg.norm(centre) / math.sqrt(len(centre))
    return v.tolist()


def planted(rng, dim=24):
    rows = [rng.normal(size=dim).tolist() for _ in range(500)]
    rows += [near(rng, np.array(rows[i]), 0.1) for i in range(0, 80)]        # pairs
    c = rng.normal(size=dim)
    rows += [near(rng, c, 0.08) for _ in range(150)]                          # a dense group
    rows += [near(rng, c, 0.25) for _ in range(120)]                          # its surroundings, about the threshold
    rows += [rows[3]] * 40 + [(np.array(rows[3]) * 4).tolist()] * 3           # copies
    a, b = rng.normal(size=dim), rng.normal(size=dim)
    b -= a * (a @ b) / (a @ a)
    b *= np.linalg.norm(a) / np.linalg.norm(b)
    rows += [(a * math.cos(t) + b * math.sin(t)).tolist() for t in np.arange(0, 2.5, 0.06)]  # a chain
    return rows


@pytest.mark.parametrize("size", [(64, 1024), (8, 7)])
def test_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(nn_descent, "CHUNK", size[0])
    monkeypatch.setattr(nn_descent, "TILE", size[1])
    rng = np.random.default_rng(2)
    rows = list(enumerate(planted(rng)))
    rng.shuffle(rows)
    rows = [(int(i), [float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<double>, code string, key int").repartition(4)
    out, recall = nn_descent.near_duplicates(df)
    got, want = sorted(tuple(r) for r in out.collect()), brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))  # no false link
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found >= 0.98 * true
    assert recall >= 0.98
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.97 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0]), (3, [0.0, 5.0]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]),
            (11, [1e308, 1e308]), (12, [1e-300, 1e-300]), (None, [1.0, 0.0]), (13, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out, recall = nn_descent.near_duplicates(df)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows)
    assert recall == 1.0


def test_empty_table(spark):
    assert nn_descent.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"))[0].count() == 0


def test_one_dense_group_without_pairs(spark):
    rng = np.random.default_rng(0)
    c = rng.normal(size=16)
    rows = [(i, near(rng, c, 0.05)) for i in range(2000)] + [(3000 + i, rng.normal(size=16).tolist()) for i in range(50)]
    out, _ = nn_descent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    group = out.where("vec_id < 2000").select("n_links", "component_id").distinct().collect()
    assert [tuple(r) for r in group] == [(1999, 0)]
