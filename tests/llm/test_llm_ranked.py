import math
import random
import re
from collections import Counter

import pytest

from chronodim.llm import ranked


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k):
    """(item row, item, rank, doc, score), documents scored one by one."""
    bags = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    total, length = len(bags), sum(n for *_, n in bags)
    df = Counter(w for _, c, _ in bags for w in c)
    out = []
    for row, (item, t) in enumerate(items):
        scored = []
        for i, c, n in bags:
            m = 100 - 75 + (75 * n * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in words(t) if c[w])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(row, item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return out


def texts(rng, n):
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Ärger", "naïve", "中文", "A1b"]
    return [rng.choice([" ", ", ", "\n", "_"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("slab,block_bytes", [(1 << 20, 1 << 20), (40, 300)])
def test_against_brute_force(spark, monkeypatch, slab, block_bytes):
    monkeypatch.setattr(ranked, "SLAB", slab)
    rng = random.Random(3)
    docs = list(enumerate(texts(rng, 250))) + [(300 + i, "w1 w2 w3") for i in range(25)]  # ties
    docs += [(7, "w1 w9"), (None, "w1 w2 w3"), (None, "w5 w5"), (401, None), (402, ""), (403, " -- "), (404, "w2 " * 5000)]
    items = [(i, t) for i, t in enumerate(texts(rng, 12))] + [(3, "w1 w1 W1"), (None, "w2"), (20, None), (21, ""), (22, "nowhere")]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, rank int").repartition(3)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id long").coalesce(1)
    got = ranked.search(d, q, block_bytes=block_bytes).collect()
    assert {(r.item_row, r.item_id) for r in got} <= set(enumerate(i for i, _ in items))
    assert sorted((tuple(r) for r in got), key=str) == sorted(brute(docs, items, 10), key=str)


def test_string_ids_and_empty_tables(spark):
    d = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "two"), ("d", "three"), ("e", "four")], "doc_id string, text string")
    q = spark.createDataFrame([("x", "ONE two")], "item_id string, text string")
    assert [(r.item_id, r.rank, r.doc_id) for r in ranked.search(d, q).orderBy("rank").collect()] == [("x", 1, "a"), ("x", 2, "b"), ("x", 3, "c")]
    assert ranked.search(d.limit(0), q).count() == 0
    assert ranked.search(d, q.limit(0)).count() == 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(ranked, "PIECE", 5)
    t = ("Abc déf-" * 50 + "x" * 40).encode()
    assert [w.decode() for some in ranked.terms(t) for w in some] == words(t.decode())


def test_few_accumulators_for_items_with_rare_terms():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(0)
    n = 4000
    doc = np.concatenate([np.arange(n), rng.choice(n, 60, replace=False)])
    term = np.array([0] * n + [1] * 60)
    r = ranked.Ranker([[(0, 1), (1, 1)]], np.array([1, 4000]), np.array([n, 60]), n, n * 3, 10)
    r.add(pa.array(np.arange(n)), np.full(n, 3), doc, term, np.ones(len(doc), np.int64))
    assert r.made == 60
    assert len(r.best[0]) == 10
