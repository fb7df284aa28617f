"""Quality classifier by co-training two views of a document.

The text view sees the content: frequencies of character-class pairs, the
shares of distinct words and lines and the word length.  The metadata view
sees the page: language, source, size class, lines and line length.  Each
round either view labels the documents it is surest of for the other view, and
both are fitted again.  At the end each view is calibrated and the two are
combined on labelled rows that neither was fitted on, and every document is
scored.

The labelled sample is bounded: at most ``LABELLED`` rows, those of least hash
(from rows whose crc32(doc_id) mod 5 isn't 0); a document repeated with its id,
label and text counts once.  The pool of pseudo-labels is every row without a
label: their features are written once, each round scores them all in Spark and
takes the surest ``SURE`` a view (equal ones once).

Edge cases: null and empty texts and null metadata have features like any
other; a null label is no label; of several labels for a doc_id each counts;
with labelled rows of one class only (or none) every score is that class's
share (or 0.5), and rows with a score of 0.5 or more are kept; repeated rows
and extra columns are harmless (they travel in the row struct); an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodim.llm.common import column, map_arrow, slices, stage, table, text_bytes
from chronodim.plans.session import broadcast_if_small

LABELLED = 10_000
ROUNDS = 4
SURE = 400       # pseudo-labels a view gives in a round, at most
SURE_AT = 0.95   # and how sure it must be
RIDGE = 1.0

CLASSES = 24
META = 64 + 16 + 24 + 16 + 16


def class_table() -> np.ndarray:
    """Class of each byte: letters, digits, blanks and groups of signs."""
    out = np.zeros(256, np.int64)
    out[0x80:] = 1
    for b in range(128):
        c = chr(b)
        out[b] = 2 if c.islower() else 3 if c.isupper() else 4 if c.isdigit() else 5 if c == " " else 6 if c == "\n" else 7
    for i, c in enumerate(".,;:!?'\"-_|%$#&*"):
        out[ord(c)] = 8 + i
    return out


CLASS = class_table()


def text_features(text: bytes) -> np.ndarray:
    x = np.zeros(CLASSES * CLASSES + 5, np.float32)
    if not text:
        x[-1] = 1
        return x
    c = CLASS[np.frombuffer(text, np.uint8)]
    pairs = np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)[:CLASSES * CLASSES]
    x[:CLASSES * CLASSES] = np.sqrt(pairs / max(1, len(text) - 1))
    words, lines = text.split(), text.split(b"\n")
    n = max(1, len(words))
    x[-5:-1] = len(set(words)) / n, len(set(lines)) / len(lines), min(len(text) / n / 10, 5), np.log1p(n) / 10
    return x


def bucket(value: bytes, n: int) -> int:
    return zlib.crc32(value) % n


def meta_features(text: bytes, lang, source, n_chars) -> list[int]:
    """Active coordinates of the metadata view."""
    lines = text.count(b"\n") + 1
    size = int(np.log2(1 + max(0, n_chars or 0)))
    return [bucket(str(source).encode(), 64), 64 + bucket(str(lang).encode(), 16), 80 + min(23, size), 104 + min(15, int(np.log2(lines))),
            120 + min(15, int(np.log2(1 + len(text) / lines)))]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None, ridge: float = RIDGE, steps: int = 6, rows: np.ndarray | None = None) -> np.ndarray:
    """Ridge logistic regression by Newton steps over the rows ``rows`` of
    ``x``, a block of rows at a time; the bias comes last."""
    rows = np.arange(len(x)) if rows is None else rows
    size = x.shape[1] + 1
    w = np.zeros(size) if start is None else start.copy()
    penalty = np.full(size, ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        g, h = penalty * w, np.diag(penalty)
        for at in range(0, len(rows), 2048):
            some = rows[at:at + 2048]
            b = np.concatenate((x[some], np.ones((len(some), 1), x.dtype)), axis=1)
            p = sigmoid(b @ w)
            g += b.T @ (p - y[at:at + 2048])
            h += (b * np.maximum(p * (1 - p), 1e-4)[:, None].astype(x.dtype)).T @ b
        step = np.linalg.solve(h, g)
        w -= step * min(1, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-3:
            break
    return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def dense_meta(active: np.ndarray) -> np.ndarray:
    x = np.zeros((len(active), META), np.float32)
    x[np.arange(len(active))[:, None], active] = 1
    return x


def pick(keys: list, views: list[np.ndarray], w: list, taken: list, most: tuple[int, int], best: dict) -> None:
    """Adds to ``best``, for each (view, label), the rows (-sure, key, features of
    both views) that the view is surest of and the other was not given yet; at
    most ``most`` by label, equal keys once."""
    for v, x in enumerate(views):
        p = sigmoid(logits(x, w[v]))
        for label, sure in ((0, 1 - p), (1, p)):
            rows = best.setdefault((v, label), {})
            worst = None  # of the rows, once they are as many as asked for
            for i in np.argsort(-sure, kind="stable").tolist():
                if sure[i] < SURE_AT or not most[label]:
                    break
                if keys[i] in taken[1 - v] or keys[i] in rows:
                    continue
                if len(rows) >= most[label]:
                    worst = worst or max((r[0], k) for k, r in rows.items())
                    if -sure[i] > worst[0]:
                        break
                    if (-sure[i], keys[i]) > worst:
                        continue
                    del rows[worst[1]]
                    worst = None
                rows[keys[i]] = (-float(sure[i]), [u[i] for u in views])


def local_pool(text: np.ndarray, meta: np.ndarray):
    """Pool of rows in memory."""
    def sure(w, taken, most):
        best: dict = {}
        pick(list(range(len(text))), [text, meta], w, taken, most, best)
        return best

    return sure


def spark_pool(rows: DataFrame):
    """Pool of the features table ``rows`` (key, x, m): scored in Spark, the surest
    rows of each task meet."""
    def sure(w, taken, most):
        shared = rows.sparkSession.sparkContext.broadcast((w, taken, most))

        def run(batches):
            w, taken, most = shared.value
            best: dict = {}
            for b in batches:
                if b.num_rows:
                    pick(b.column("key").to_pylist(), list(unpacked(b)), w, taken, most, best)
            out = [(v, label, k, r[0], r[1][0].tobytes(), r[1][1].tobytes()) for (v, label), found in best.items() for k, r in found.items()]
            if out:
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["v", "label", "key", "rank", "x", "m"])

        found = map_arrow(rows.select("key", "x", "m"), run, "v int, label int, key binary, rank double, x binary, m binary").dropDuplicates(["v", "label", "key"])
        nth = F.row_number().over(W.partitionBy("v", "label").orderBy("rank", "key"))
        top = F.when(F.col("label") == 1, F.lit(most[1])).otherwise(F.lit(most[0]))
        best: dict = {}
        for r in found.withColumn("n", nth).where(F.col("n") <= top).orderBy("v", "label", "n").collect():  # at most 4 SURE rows
            best.setdefault((r["v"], r["label"]), {})[bytes(r["key"])] = (r["rank"], [np.frombuffer(r["x"], np.float32), np.frombuffer(r["m"], np.float32)])
        return best

    return sure


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, fold: np.ndarray, rounds: int = ROUNDS, pool=None) -> dict:
    """Weights of both views, their calibration and their combination.

    y: 0, 1, or -1 for rows of the pool, unless ``pool`` gives the surest rows;
    fold: rows to calibrate on."""
    known = y >= 0
    share = float(y[known].mean()) if known.any() else 0.5
    calibrate, train = known & fold, known & ~fold
    if len(set(y[train].tolist())) < 2 or len(set(y[calibrate].tolist())) < 2:
        return {"share": share}
    views = [text, meta]
    pool = pool or local_pool(text[~known], meta[~known])
    given = [(x[train], y[train].astype(float)) for x in views]
    taken: list = [set(), set()]
    most = (int(np.ceil(SURE * (1 - share))), int(np.ceil(SURE * share)))  # as many of each class as the labels have
    w: list = [None, None]
    for r in range(rounds + 1):
        for v, (x, label) in enumerate(given):
            w[v] = logistic(x, label, w[v], steps=6 if r == 0 else 2)
        if r == rounds:
            break
        for (v, label), rows in pool(w, taken, most).items():
            if rows:
                taken[1 - v] |= set(rows)
                more = np.stack([r[1][1 - v] for r in rows.values()])
                x, old = given[1 - v]
                given[1 - v] = np.concatenate((x, more)), np.append(old, np.full(len(more), float(label)))
    # Platt calibration of each view, then the combination of both
    scores = np.stack([logits(x[calibrate], w[v]) for v, x in enumerate(views)], axis=1)
    platt = [logistic(scores[:, v:v + 1], y[calibrate], ridge=1e-2, steps=20) for v in range(2)]
    both = np.stack([scores[:, v] * platt[v][0] + platt[v][1] for v in range(2)], axis=1)
    return {"w": w, "platt": platt, "mix": logistic(both, y[calibrate], ridge=1e-2, steps=20)}


def prepared(df: DataFrame, text_col: str) -> DataFrame:
    """row (without the text), text, and metadata columns (null where ``df``
    has no such column)."""
    def meta(name, kind):
        return (column(name) if name in df.columns else F.lit(None)).cast(kind).alias(f"m_{name}")

    return df.select(F.struct(*[column(c) for c in df.columns if c != text_col]).alias("row"), text_bytes(text_col).alias("text"),
                     meta("lang", "string"), meta("source", "string"), meta("n_chars", "long"))


def meta_of(b: pa.RecordBatch) -> np.ndarray:
    rows = zip(*[b.column(c).to_pylist() for c in ("text", "m_lang", "m_source", "m_n_chars")], strict=True)
    return np.array([meta_features(*r) for r in rows], np.int64).reshape(-1, 5)


def unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(b.column(c).to_pylist()), np.float32).reshape(b.num_rows, -1) for c in ("x", "m"))


def feature_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key (digest of the features), x and m (features of both views) of
    every row, written."""
    src = prepared(df, text_col).select(F.col("row").getField(id_col).alias("id"), "text", "m_lang", "m_source", "m_n_chars")

    def run(batches):
        for b in slices(batches):
            x = [text_features(t).tobytes() for t in b.column("text").to_pylist()]
            m = [r.tobytes() for r in dense_meta(meta_of(b))]
            key = [hashlib.blake2b(t + u, digest_size=16).digest() for t, u in zip(x, m, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(c, pa.binary()) for c in (key, x, m)]], names=["id", "key", "x", "m"])

    return stage(map_arrow(src, run, T.StructType([src.schema["id"], *[T.StructField(c, T.BinaryType()) for c in ("key", "x", "m")]])), "quality-features")


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", labelled: int = LABELLED) -> dict:
    """The model (a few thousand numbers), from at most ``labelled`` rows with a
    label and all rows without."""
    named = labels.select(column(id_col).alias("id"), column(label).cast("int").alias("y")).where("y in (0, 1) and id is not null")
    usable = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) != 0
    rank = F.xxhash64(F.col("id"), F.lit(5))
    chosen = named.where(usable).orderBy(rank, "id", "y").limit(labelled)
    rows = feature_table(df, id_col, text_col)
    # one row per id, label and text, then the bound again: an id may have many texts
    sample = rows.join(F.broadcast(chosen), "id").dropDuplicates(["id", "y", "key"]).orderBy(rank, "id", "y", "key").limit(labelled)
    sample = stage(sample, "quality-sample").orderBy(rank, "id", "y", "key").toArrow()
    if not sample.num_rows:
        return {"share": 0.5}
    whole = sample.combine_chunks().to_batches()[0]
    x, m = unpacked(whole)
    fold = np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in whole.column("id").to_pylist()])
    pool = rows.join(broadcast_if_small(named.select("id").distinct()), "id", "left_anti")
    return co_train(x, m, whole.column("y").to_numpy(), fold, pool=spark_pool(pool))


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None, **limits) -> DataFrame:
    """(row struct without the text, text binary, text_score, meta_score,
    score) for every row of ``df``; score is the calibrated probability of
    good quality by both views."""
    model = model or fit(df, labels, id_col, text_col, **limits)
    shared = df.sparkSession.sparkContext.broadcast(model)
    src = prepared(df, text_col)

    def run(batches):
        m = shared.value
        for b in slices(batches):
            n = b.num_rows
            if "share" in m:
                views, score = [np.full(n, m["share"])] * 2, np.full(n, m["share"])
            else:
                x = np.stack([text_features(t) for t in b.column("text").to_pylist()])
                z = [logits(x, m["w"][0]), logits(dense_meta(meta_of(b)), m["w"][1])]
                z = [s * p[0] + p[1] for s, p in zip(z, m["platt"], strict=True)]
                views, score = [sigmoid(s) for s in z], sigmoid(logits(np.stack(z, axis=1), m["mix"]))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("text"), *[pa.array(v.astype(float)) for v in (*views, score)]],
                                             names=["row", "text", "text_score", "meta_score", "score"])

    return map_arrow(src, run, T.StructType([src.schema["row"], src.schema["text"], *[T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "score")]]))


def keep_good(df: DataFrame, labels: DataFrame, at: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """``df``'s rows with a score of ``at`` or more, columns as they were."""
    out = quality(df, labels, text_col=text_col, **options).where(F.col("score") >= at)
    return out.select(*[column("text").cast("string").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: quality of every document."""
    scored = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("row.doc_id").alias("doc_id"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
