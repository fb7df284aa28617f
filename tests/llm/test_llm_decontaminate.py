import random

import numpy as np
from brute import SF, contamination

from chronodim.llm import decontaminate as dc


def compare(spark, docs, items, **options):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(docs)], "doc_id long, text string, n_words long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dc.decontaminate(df, bench, **options)
    got = {r["row"].doc_id: (r.n_words, r.n_hit, len(r["items"]), dc_sha(r["items"]), r.contaminated) for r in out.collect()}
    assert [got[i] for i in range(len(docs))] == contamination(docs, items)
    return out


def dc_sha(items):
    import hashlib

    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = contamination([d.text for d in docs], items)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in dc.query(spark, SF).collect()}
    assert [got[d.doc_id] for d in docs] == want


def test_small_vocabulary_repeats_blocks(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abAB") for _ in range(n))
    items = [(i, text(rng.choice([13, 16, 20]))) for i in range(12)] + [(3, text(14)), (99, "a b a"), (98, "Z"), (97, None), (96, "--"), (None, text(15))]
    docs = [text(rng.randint(0, 120)) for _ in range(60)] + [None, "", "!!!", "z", "x z. y", "z z z"] + [items[0][1]] * 5 + ["pre " + items[1][1] + " post"]
    compare(spark, docs, items)
    compare(spark, docs, items, block_bytes=60)


def test_spans_cover_the_passage(spark):
    passage = "Über one, two three four five six seven eight nine ten eleven twelve"
    doc = f"Start: ({passage}) end."
    r = dc.decontaminate(spark.createDataFrame([(1, doc)], "doc_id long, text string"), spark.createDataFrame([(1, passage)], "item_id long, text string")).first()
    (a, b), = r.spans
    assert doc.encode()[a:b].decode() == passage


def test_empty_tables_and_rule(spark):
    docs = spark.createDataFrame([(1, "a " * 13), (2, "a " * 13 + "b " * 300)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a " * 13)], "item_id long, text string")
    assert [r.doc_id for r in dc.keep_clean(docs, bench).collect()] == [2]
    assert dc.keep_clean(docs, bench.limit(0)).count() == 2
    assert dc.keep_clean(docs.limit(0), bench).count() == 0


def test_ids_are_of_any_type(spark):
    docs = spark.createDataFrame([(1, "a " * 13), (2, "q")], "doc_id long, text string")
    bench = spark.createDataFrame([("x", "a " * 14), ("b", "a " * 13), ("b", "a " * 13), (None, "q"), ("c", None)], "item_id string, text string")
    got = {r["row"].doc_id: (r["items"], r.n_hit) for r in dc.decontaminate(docs, bench).collect()}
    assert got == {1: (["b", "x"], 13), 2: ([], 1)}


def test_windows_and_their_items():
    w = dc.windows_of([(7, b"a b c"), (8, b"b c"), (9, b"a"), (None, b"b c d"), (7, b"a b c"), (5, b"")], 2)
    words = {v: k for k, v in w["vocabulary"].items()}
    got = {b" ".join(words[x] for x in p if x): [w["ids"][k] for k in w["owner"][w["start"][i]:w["start"][i + 1]]] for i, p in enumerate(w["phrases"])}
    assert got == {b"a b": [7], b"b c": [7, 8], b"a": [9], b"c d": []}
    assert dc.windows_of([], 13)["phrases"].shape == (0, 13)


def test_index_finds_all_occurrences():
    rng = np.random.default_rng(5)
    s = np.concatenate([np.append(rng.integers(1, 5, n), 0) for n in (200, 1, 57, 300, 300)])
    s[-301:-1] = s[-602:-302]  # one stretch twice
    index = dc.FMIndex(s, 4)
    for n in (1, 2, 5, 9):
        for at in rng.integers(0, 150, 20):
            p = s[at:at + n]
            lo, hi = index.search(p[None, :], np.array([n]))
            want = [i for i in range(len(s) - n + 1) if (s[i:i + n] == p).all()]
            assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want
