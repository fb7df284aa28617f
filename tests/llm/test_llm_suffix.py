import random

import pytest
from brute import SF, sha, without_repeats

from chronodim.llm import suffix_dedup as sd


def run(spark, texts, length):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["row"].doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sd.suffix_dedup(df, length=length).collect()}
    return [got[i] for i in range(len(texts))]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = without_repeats([d.text for d in docs])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.query(spark, SF).collect()}
    assert [got[d.doc_id] for d in docs] == [(*w[:3], sha(w[3])) for w in want]


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages_against_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(8, 60))) for _ in range(6)]
    texts = [None, "", "x" * 500, "y" * 39, "z" * 40, "z" * 40, "ab" * 300]
    for _ in range(60):
        t = ""
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            t += " ".join(word() for _ in range(rng.randint(0, 12))) + p[a:a + rng.randint(20, 300)]
        texts.append(t)
        if rng.random() < 0.2:
            i = rng.randrange(len(t) + 1)
            texts.append(t[:i] + rng.choice(["", "Q", "QQ"]) + t[i:])
    monkeypatch.setattr(sd, "PIECE", 150)  # long texts in pieces
    assert run(spark, texts, 40) == without_repeats(texts, 40)


def test_one_very_common_gram_in_unequal_places(spark):
    rng = random.Random(9)
    line = "the same licence line stands in every one of these texts "
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(90)) + line + "".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(150)]
    assert run(spark, texts, 60) == without_repeats(texts, 60)
    assert run(spark, texts, 50) == without_repeats(texts, 50)


@pytest.mark.parametrize("crowd", [2, 4])
def test_grams_settled_in_the_tasks(spark, monkeypatch, crowd):
    monkeypatch.setattr(sd, "CROWD", crowd)
    rng = random.Random(crowd)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 6)))
    passage = " ".join(word() for _ in range(40))
    texts = []
    for _ in range(120):
        a, b = sorted(rng.sample(range(len(passage)), 2))
        texts.append(" ".join(word() for _ in range(rng.randint(0, 8))) + passage[a:b] + rng.choice([" ", passage, "Q"]) + word())
    want = without_repeats(texts, 40)
    assert run(spark, texts, 40) == want
    monkeypatch.setattr(sd, "KNOWN", 3)
    assert run(spark, texts, 40) == want


def test_cut_keeps_columns_and_whole_characters(spark):
    shared = "é" * 120
    rows = [(1, "a" + shared + "b", 5, "t"), (2, "ax" + shared + "c", 5, "t"), (3, None, None, "t"), (None, "solo", 4, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, tid string")
    out = sd.cut(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text, r.n_chars, r.tid) for r in out.collect()) == [("1", "ab", 2, "t"), ("2", "axc", 3, "t"), ("3", "", 0, "t"), ("None", "solo", 4, "t")]
    assert sd.cut(df.limit(0)).count() == 0
