"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features of a text are its distinct words, word pairs and skip-grams (pairs
with one or two words between), hashed to ``2 ** BITS`` coordinates.  FTRL
gives each coordinate its own rate, and its L1 term leaves only few weights
other than zero, so the model is a short list of (coordinate, weight) that is
broadcast (bounded by 2 ** BITS entries).

Fitting uses a bounded sample of labelled rows: at most ``SAMPLE_ROWS``,
those of least hash, from rows whose crc32(doc_id) mod 5 isn't 0; a document
repeated with its id, label and text counts once.  Features are made where the
texts are; one task then learns from the sample's coordinates.  Scoring covers
every whole text.

Edge cases: null and empty texts have no features and score by the bias; a
null label is no label; of several labels for one doc_id each counts; rows
with a null doc_id are scored, not held out; with no labelled rows all scores
are 0.5 and predicted is 1; repeated rows and extra columns are harmless; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodim.llm.common import column, map_arrow, slices, table, text_bytes

BITS = 20
SAMPLE_ROWS = 20_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 3.0, 1.0, 15.0, 1.0

WORD_BYTES = bytes(b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
#: kind of feature: words between the two (None: the word alone), multiplier
KINDS = ((None, 0x9E3779B97F4A7C15), (0, 0xC2B2AE3D27D4EB4F), (1, 0x165667B19E3779F9), (2, 0xD6E8FEB86659FD93))


def word_hashes(text: bytes) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, text.translate(WORD_BYTES).split())), ">u8").astype(np.uint64)


def features(h: np.ndarray):
    """Coordinates of the words and pairs of a text, repeats included."""
    shift = np.uint64(64 - BITS)
    out = []
    for gap, m in KINDS:
        x = h if gap is None else h[:-1 - gap] * np.uint64(0xFF51AFD7ED558CCD) + h[1 + gap:]
        out.append(((x ^ (x >> np.uint64(31))) * np.uint64(m)) >> shift)
    return np.concatenate(out).astype(np.int64)


class Ftrl:
    """One-pass FTRL-proximal logistic regression; the last coordinate is the
    bias, which has no L1 term."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.size = size

    def weights(self, i: np.ndarray) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        l1 = np.where(i == self.size, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, i: np.ndarray, y: int) -> None:
        w = self.weights(i)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30)))
        g = p - y
        sigma = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / ALPHA
        self.z[i] += g - sigma * w
        self.n[i] += g * g


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> dict[int, float]:
    """Weights other than zero by coordinate; 2 ** BITS is the bias.

    docs: doc_id, text (binary); labels: doc_id and the 0/1 label."""
    chosen = labels.select("doc_id", column(label).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null") \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows)

    def examples(batches):
        for b in slices(batches):
            found = [np.unique(features(word_hashes(t))).astype(np.int32) for t in b.column("text").to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found])))
            key = [xxhash.xxh3_128_digest(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(key, pa.binary()), pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(np.concatenate(found) if found else [], pa.int32()))], names=["doc_id", "y", "key", "x"])

    rows = map_arrow(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text"), examples, "doc_id long, y int, key binary, x array<int>")
    # an id may have many texts: the bound holds for the rows, too
    few = rows.select("doc_id", "y", "key").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "y", "key").limit(sample_rows)
    rows = rows.join(F.broadcast(few.withColumn("one", F.lit(1))), ["doc_id", "y", "key"]).dropDuplicates(["doc_id", "y", "key"])

    def train(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("key", "ascending")])
        y = t.column("y").to_pylist()
        x = t.column("x").combine_chunks()
        offsets, values = np.asarray(x.offsets), np.asarray(x.values)
        model, turn = Ftrl(1 << BITS), np.random.default_rng(7)
        for _ in range(EPOCHS):
            for k in turn.permutation(len(y)):
                model.learn(np.append(values[offsets[k]:offsets[k + 1]], model.size).astype(np.int64), y[k])
        w = model.weights(np.arange(model.size + 1))
        i = np.flatnonzero(w)
        return pa.table({"i": pa.array(i, pa.int64()), "w": pa.array(w[i])})

    return {r["i"]: r["w"] for r in rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, "i long, w double").collect()}


def score(df: DataFrame, weights: dict[int, float], text_col: str = "text") -> DataFrame:
    """``df``'s rows, but for the text, as struct ``row`` with their score."""
    index = np.array(sorted(weights), np.int64)
    shared = df.sparkSession.sparkContext.broadcast((index, np.array([weights[i] for i in index.tolist()])))
    src = df.select(F.struct(*[column(c) for c in df.columns if c != text_col]).alias("row"), text_bytes(text_col).alias("text"))

    def run(batches):
        index, value = shared.value
        dense = np.zeros((1 << BITS) + 1)
        dense[index] = value
        bias, used = dense[-1], dense != 0
        for b in slices(batches):
            total = []
            for t in b.column("text").to_pylist():
                x = features(word_hashes(t))
                total.append(bias + dense[np.unique(x[used[x]])].sum())
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(1 / (1 + np.exp(-np.clip(np.array(total, float), -30, 30))))], names=["row", "score"])

    return map_arrow(src, run, T.StructType([src.schema["row"], T.StructField("score", T.DoubleType())]))


def held_out(id_col: F.Column, modulus: int = 5, remainder: int = 0) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    train = labels.where(~held_out(F.col("doc_id")))
    weights = fit(docs.select("doc_id", text_bytes("text").alias("text")), train, sample_rows=sample_rows)
    return score(docs.select("doc_id", "text"), weights).select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: toxicity of every document."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
