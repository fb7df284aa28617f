"""Benchmark decontamination by an FM-index over each shard of documents.

Each shard (a few megabytes of whole documents inside a task) is turned into
word numbers of the benchmark's vocabulary.  Words that the benchmark never
uses can't lie in an occurrence, so only stretches of benchmark words as long
as the shortest window are indexed.  The index is the Burrows-Wheeler
transform of the stretches in a wavelet tree (matrix form); all benchmark
windows are searched backwards at once by wavelet ranks, found rows are
located by walking to sampled suffix positions, and the word spans found are
merged per document.

The benchmark is broadcast in blocks of about ``BLOCK_BYTES`` of text (equal
rows once), each block run against every shard, so its size is unbounded.

Edge cases: null or empty texts have no words, no hits and are not
contaminated; benchmark items without words match nothing; items are told
apart by item_id, repeated ids count once and items with a null id mark words
but are not listed (ids are of any type that sorts); repeated documents are judged one by one; an empty table
on either side works; extra columns of documents travel in the row struct.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodim.llm.common import column, map_arrow, slices, table, text_bytes

WINDOW = 13
BLOCK_BYTES = 4 << 20  # of benchmark text: under a million windows of 52 bytes
SHARD_BYTES = 4 << 20  # of documents in an index
SAMPLE = 8  # every so many text positions have their suffix position kept

# ASCII letters in lower case, digits and all bytes above 0x7F are word bytes
WORD_BYTES = bytes(b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


# ---- the index -----------------------------------------------------------
def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by prefix doubling."""
    n, rank, k = len(s), np.unique(s, return_inverse=True)[1].astype(np.int64), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-k if k < n else n] = rank[k:] + 1
        key = rank * (n + 1) + ahead
        sa = np.argsort(key, kind="stable")
        key = key[sa]
        new = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank = np.empty(n, np.int64)
        rank[sa] = new
        if new[-1] == n - 1 or k >= n:
            return sa
        k *= 2


class WaveletTree:
    """Ranks over a sequence of small integers, all levels of the tree laid
    end to end (matrix form)."""

    def __init__(self, x: np.ndarray, sigma: int):
        self.levels, self.bits = [], max(1, int(sigma).bit_length())
        for b in range(self.bits - 1, -1, -1):
            bit = ((x >> b) & 1).astype(bool)
            ones = np.concatenate(([0], np.cumsum(bit))).astype(np.int64)
            zeros = len(x) - int(ones[-1])
            self.levels.append((ones, zeros))
            x = np.concatenate((x[~bit], x[bit]))

    def down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first ``i`` entries' occurrences of ``symbol`` end on the
        lowest level."""
        for level, (ones, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            r = ones[i]
            i = np.where(one, zeros + r, i - r)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.down(symbol, i) - self.down(symbol, np.zeros_like(i))


class FMIndex:
    """Index of ``s``: 0 separates stretches, 1 to sigma are words."""

    def __init__(self, s: np.ndarray, sigma: int):
        n = len(s)
        zero = s == 0
        # separators differ, so no common prefix goes beyond a stretch
        sa = suffix_array(np.where(zero, np.cumsum(zero), s + n))
        self.bwt = s[sa - 1]
        self.tree = WaveletTree(self.bwt, sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=sigma + 1))))
        # no walk crosses a separator: stretches' first positions are kept too
        self.sampled = (sa % SAMPLE == 0) | zero[sa - 1]
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))
        self.samples = sa[self.sampled]
        self.n = n

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.tree.rank(symbol, i)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases, one a line, words right-aligned."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        width = phrases.shape[1]
        for k in range(width):
            live = live[(lengths[live] > k) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = phrases[live, width - 1 - k]
            lo[live], hi[live] = self.step(c, lo[live]), self.step(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        rows, moved = rows.copy(), np.zeros(len(rows), np.int64)
        walk = np.flatnonzero(~self.sampled[rows])
        while len(walk):
            c = self.bwt[rows[walk]]
            rows[walk] = self.step(c, rows[walk])
            moved[walk] += 1
            walk = walk[~self.sampled[rows[walk]]]
        return self.samples[self.sample_rank[rows]] + moved


# ---- the benchmark -------------------------------------------------------
def windows_of(items: list[tuple], window: int) -> dict:
    """Vocabulary, right-aligned windows and the items of each window: those of
    window ``w`` are ``ids[owner[start[w]:start[w + 1]]]``."""
    vocabulary: dict[bytes, int] = {}
    names: dict = {}
    phrases, owners = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int64)]
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        if ids:
            padded = np.array([0] * (window - len(ids)) + ids, np.int32)
            phrases.append(np.lib.stride_tricks.sliding_window_view(padded, window))
            owners.append(np.full(len(phrases[-1]), -1 if item is None else names.setdefault(item, len(names))))
    whole, owner = np.concatenate(phrases), np.concatenate(owners)
    _, first, which = np.unique(whole.view(np.dtype((np.void, 4 * window))).ravel(), return_index=True, return_inverse=True)
    whole = whole[first].astype(np.int64)
    pairs = np.unique(which[owner >= 0] * max(1, len(names)) + owner[owner >= 0])
    which, owner = np.divmod(pairs, max(1, len(names)))
    return {"vocabulary": vocabulary, "phrases": whole, "lengths": (whole > 0).sum(axis=1), "ids": list(names),
            "owner": owner, "start": np.searchsorted(which, np.arange(len(whole) + 1))}


def blocks_of(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    rows = items.select(column(id_col).alias("item"), text_bytes(text_col).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    return [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def find_hits(texts: list[bytes], bench: dict) -> list[tuple[int, list, list]]:
    """(words, merged word spans, items) of each text of a shard."""
    number, numbers, sizes = bench["vocabulary"].get, [], []
    for t in texts:
        ids = [number(w, 0) for w in words_of(t)]
        numbers += ids
        sizes.append(len(ids))
    out: list[tuple[int, list, list]] = [(n, [], []) for n in sizes]
    x = np.array(numbers, np.int64)
    if not len(x) or not len(bench["lengths"]):
        return out
    ends = np.cumsum(sizes)
    # stretches of benchmark words within one document
    doc = np.repeat(np.arange(len(sizes)), sizes)
    inside = x > 0
    edge = np.concatenate(([True], (inside[1:] != inside[:-1]) | (doc[1:] != doc[:-1])))
    first = np.flatnonzero(edge)
    length = np.diff(np.append(first, len(x)))
    good = inside[first] & (length >= bench["lengths"].min())
    first, length = first[good], length[good]
    if not len(first):
        return out
    at = np.repeat(first - np.concatenate(([0], np.cumsum(length + 1)[:-1])), length + 1) + np.arange(int((length + 1).sum()))
    close = np.cumsum(length + 1) - 1
    s = x[np.minimum(at, len(x) - 1)]
    s[close] = 0
    index = FMIndex(s, int(bench["phrases"].max()))
    lo, hi = index.search(bench["phrases"], bench["lengths"])
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    if not len(which):
        return out
    rows = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(len(which))
    begin = at[index.locate(rows)]
    of = doc[begin]
    begin = begin - (ends - sizes)[of]
    order = np.lexsort((begin, of))
    ids, owner, start = bench["ids"], bench["owner"].tolist(), bench["start"].tolist()
    for d, i, w in zip(of[order].tolist(), begin[order].tolist(), which[order].tolist(), strict=True):
        spans, end = out[d][1], i + int(bench["lengths"][w])
        if spans and i <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([i, end])
        out[d][2].extend(ids[k] for k in owner[start[w]:start[w + 1]])
    return out


def merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for i, j in sorted(spans):
        if out and i <= out[-1][1]:
            out[-1][1] = max(out[-1][1], j)
        else:
            out.append([i, j])
    return out


def decontaminate(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, share: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row struct with the text, n_words, n_hit, items, spans, contaminated)
    for every row of ``df``.

    ``spans`` are the merged removal spans as byte ranges of the text;
    ``contaminated`` if share * n_hit >= n_words > 0 with a hit."""
    sc = df.sparkSession.sparkContext
    listed_as = T.ArrayType(items.schema[item_id].dataType)
    rows = df.select(F.struct(*[column(c) for c in df.columns]).alias("row"), text_bytes(text_col).alias("text"),
                     F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<long>>").alias("spans"), F.array().cast(listed_as).alias("items"))
    schema = rows.schema

    for block in blocks_of(items, item_id, item_text, block_bytes):
        shared = sc.broadcast(windows_of([(r["item"], bytes(r["text"])) for r in block.collect()], window))

        def run(batches, shared=shared):
            bench = shared.value
            for b in slices(batches, limit=SHARD_BYTES):
                found = find_hits(b.column("text").to_pylist(), bench)
                spans = [merged(old + new) if old else new for old, (_, new, _) in zip(b.column("spans").to_pylist(), found, strict=True)]
                listed = [sorted({*old, *new}) if old or new else [] for old, (_, _, new) in zip(b.column("items").to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("text"), pa.array([f[0] for f in found], pa.int64()),
                                                  pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(listed, b.column("items").type)],
                                                 names=["row", "text", "n_words", "spans", "items"])

        rows = map_arrow(rows, run, schema)

    def bytes_of(batches):
        for b in slices(batches):
            hit, spans = [], []
            for text, found in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                hit.append(sum(j - i for i, j in found))
                at = [m.span() for m in WORD.finditer(text.translate(WORD_BYTES))] if found else []
                spans.append([[at[i][0], at[j - 1][1]] for i, j in found])
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("n_words"), pa.array(hit, pa.int64()), b.column("items"), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                                             names=["row", "n_words", "n_hit", "items", "spans"])

    out = map_arrow(rows, bytes_of, T.StructType([schema["row"], schema["n_words"], T.StructField("n_hit", T.LongType()), schema["items"], schema["spans"]]))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def keep_clean(df: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``df`` without its contaminated documents."""
    return decontaminate(df, items, **options).where(~F.col("contaminated")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: hits of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(names.cast("binary"), 256).alias("items_sha256"), "contaminated")
