import random

import numpy as np
import pytest
from brute import SF, components, fingerprint

from chronodim.llm import simhash


def near(a, b, d=2):
    return (a ^ b).bit_count() <= d


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    docs.sort()
    fps = [fingerprint(d.text) for d in docs]
    comp = components(fps, near)
    got = {r.doc_id: r for r in simhash.query(spark, SF).collect()}
    assert len(got) == len(docs)
    for i, d in enumerate(docs):
        assert got[d.doc_id].fingerprint == f"{fps[i]:016x}" and got[d.doc_id].component_id == docs[comp[i]].doc_id


@pytest.mark.parametrize(("cap", "distance"), [(1, 2), (3, 2), (32, 2), (2, 1)])
def test_links_with_crowded_lists(spark, cap, distance):
    rng = random.Random(cap)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = {0}
    for _ in range(150):
        f = rng.choice(base)
        for _ in range(rng.randint(0, 4)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    fps = sorted(fps)
    as_long = [int(np.uint64(f).astype(np.int64)) for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in as_long], "fp long"), distance, cap)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    comp = components(fps, lambda a, b: near(a, b, distance))
    for i, f in enumerate(as_long):
        mates = [as_long[j] for j in range(len(fps)) if comp[j] == comp[i]]
        assert roots.get(f, f) == min(mates)
    pairs = {(r.hi, r.lo) for r in edges.collect()}
    assert all(near(int(a) & (2**64 - 1), int(b) & (2**64 - 1), distance) for a, b in pairs)


def test_edges(spark):
    long_text = "word " * 30000 + "end"
    rows = [(5, None, "a", 1), (3, "", "b", 2), (9, " \t\n", "c", 3), (7, "One two", "d", 4), (8, "oNE TWO", "e", 5), (8, "oNE TWO", "e", 5),
            (None, "one two", "f", 6), (11, long_text, "g", 7), (12, long_text, "g", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = [(r.doc_id, r.component_id) for r in simhash.near_groups(df).select("row.doc_id", "component_id").collect()]
    assert sorted(got, key=str) == sorted([(5, 3), (3, 3), (9, 3), (7, 7), (8, 7), (8, 7), (None, 7), (11, 11), (12, 11)], key=str)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.fp) for r in kept.collect()) == [(3, "b"), (7, "d"), (11, "g")]
    assert simhash.near_groups(df.limit(0)).count() == 0
    assert fingerprint(long_text) == simhash.fingerprint(long_text.encode()) & (2**64 - 1)


def test_long_chain(spark):
    fps = [(1 << k) - 1 for k in range(0, 63, 2)]  # each two bits from the next
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    assert {r.root for r in simhash.components(edges).collect()} == {0}
