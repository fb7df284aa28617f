import zlib

import numpy as np

from chronodim.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def labelled(spark, got, label):
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [(r, y[r.doc_id]) for r in got if r.doc_id in y]
    return [x for x in rows if zlib.crc32(str(x[0].doc_id).encode()) % 5 == 0], rows


def test_toxicity_held_out(spark):
    got = toxicity.query(spark, SF).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held, _ = labelled(spark, got, "toxic")
    assert all(r.held_out for r, _ in held)
    assert all(y for r, y in held if r.predicted), "a clean document was called toxic"
    toxic = np.mean([r.score for r, y in held if y])
    clean = np.mean([r.score for r, y in held if not y])
    assert toxic > clean + 0.3


def test_toxicity_learns_pairs_and_ignores_held_out_labels(spark):
    import random

    rng = random.Random(4)
    w = lambda n: [rng.choice("abcdefghijklmnop") * 2 for _ in range(n)]
    rows = [(i, " ".join(w(10) + (["bad", rng.choice(["x", "y"]), "thing"] if i % 3 == 0 else ["bad"] if i % 3 == 1 else ["thing"]) + w(10)), int(i % 3 == 0)) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame([(i, 1 - y if i in held else y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, labels).collect()}
    assert np.mean([got[i] == y for i, _, y in rows if i in held]) > 0.95


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (3, "a"), (3, "a"), (4, "word " * 50000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_quality_held_out(spark):
    got = quality.query(spark, SF).collect()
    assert len(got) == 1000
    held, _ = labelled(spark, got, "quality")
    assert np.mean([r.predicted == y for r, y in held]) >= 0.97
    # calibration: the mean score is near the share of good documents
    assert abs(np.mean([r.score for r, _ in held]) - np.mean([y for _, y in held])) < 0.05


def test_co_training_uses_the_pool():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 1500)
    a = (y[:, None] * 2 - 1) * 0.5 + rng.normal(size=(1500, 6))
    b = (y[:, None] * 2 - 1) * 0.5 + rng.normal(size=(1500, 6))
    known = y.copy()
    known[60:] = -1
    fold = np.arange(1500) % 3 == 0
    acc = {}
    for rounds in (0, 6):
        m = quality.co_train(a.astype(np.float32), b.astype(np.float32), known, fold, rounds)
        acc[rounds] = np.mean((quality.logits(a[60:], m["w"][0]) > 0) == y[60:])
    assert acc[6] > acc[0]


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, 9), (2, "", "en", "s", 0, 9), (3, "a b", "en", "s", -5, 9), (3, "a b", "en", "s", 3, 9)],
                                 "doc_id long, text string, lang string, source string, n_chars long, score int")
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert quality.keep_good(docs, labels).count() == 4
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.quality(docs, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    assert quality.keep_good(docs.limit(0), labels).count() == 0
    assert quality.quality(docs.select("doc_id", "text"), labels).count() == 4


def test_repeated_documents_change_no_model(spark):
    import random

    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["good", "bad", "fine", "poor", "x1", "y2"]) for _ in range(30)) + (" bad thing" * (i % 3 == 0))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 == 0)) for i in range(0, 400, 2)], "doc_id long, toxic int, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    often = docs.union(spark.createDataFrame([rows[2]] * 300 + [rows[3]] * 300, docs.schema))

    def results(op):
        return [{r.doc_id: r.score for r in op(d).collect()} for d in (docs, often)]

    once, more = results(lambda d: toxicity.toxicity(d, labels))
    assert once == more and len(set(once.values())) > 1
    once, more = results(lambda d: quality.quality(d, labels).selectExpr("row.doc_id as doc_id", "score"))
    assert all(abs(once[i] - more[i]) < 1e-9 for i in once) and len(once) == 400


def test_a_hot_labelled_id_stays_within_the_bound(spark, tmp_path, monkeypatch):
    docs = spark.range(3000).selectExpr("if(id < 2000, 1, id) as doc_id", "concat('text ', id) as text")
    labels = spark.createDataFrame([(1, 1)] + [(i, i % 2) for i in range(2000, 3000)], "doc_id long, toxic int")

    class Counted(toxicity.Ftrl):
        def learn(self, i, y):
            with open(tmp_path / "rows", "a") as f:
                f.write("x")
            super().learn(i, y)

    monkeypatch.setattr(toxicity, "Ftrl", Counted)
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    toxicity.fit(docs.selectExpr("doc_id", "cast(text as binary) as text"), labels, sample_rows=100)
    assert (tmp_path / "rows").stat().st_size == 100


def test_one_ftrl_step_against_the_formula():
    m = toxicity.Ftrl(4)
    i = np.array([1, 3, 4])
    m.z[:], m.n[:] = [0, 20, -5, 18, 2], [0, 4, 1, 9, 16]
    w = [0.0] * 5
    for k in (1, 3, 4):
        l1 = 0 if k == 4 else toxicity.L1
        if abs(m.z[k]) > l1:
            w[k] = -(m.z[k] - np.sign(m.z[k]) * l1) / ((toxicity.BETA + m.n[k] ** 0.5) / toxicity.ALPHA + toxicity.L2)
    g = 1 / (1 + np.exp(-(w[1] + w[3] + w[4]))) - 1
    want_z, want_n = m.z.copy(), m.n.copy()
    for k in (1, 3, 4):
        sigma = ((m.n[k] + g * g) ** 0.5 - m.n[k] ** 0.5) / toxicity.ALPHA
        want_z[k] += g - sigma * w[k]
        want_n[k] += g * g
    m.learn(i, 1)
    assert np.allclose(m.z, want_z) and np.allclose(m.n, want_n)


def test_pool_in_spark_equals_pool_in_memory(spark):
    import zlib as z

    rng = np.random.default_rng(3)
    text, meta = rng.normal(size=(500, 6)).astype(np.float32), rng.normal(size=(500, 4)).astype(np.float32)
    keys = [z.crc32(str(i).encode()).to_bytes(4, "big") for i in range(500)]
    rows = spark.createDataFrame([(k, bytearray(t.tobytes()), bytearray(m.tobytes())) for k, t, m in zip(keys, text, meta, strict=True)], "key binary, x binary, m binary").repartition(5)
    w = [np.array([3, 2, 0, 0, 1, 0, 0.1]), np.array([4, 0, 0, 1, 0.0])]
    taken, most = [set(keys[:50]), set(keys[50:90])], (30, 20)
    best: dict = {}
    quality.pick(keys, [text, meta], w, taken, most, best)
    got = quality.spark_pool(rows.union(rows))(w, taken, most)
    assert {k: set(v) for k, v in got.items()} == {k: set(v) for k, v in best.items()} and {len(v) for v in best.values()} == {20, 30}
