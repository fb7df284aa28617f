"""Ranked lexical search: term at a time with a limited set of accumulators.

The documents are read once a block of items: each becomes its length and its
postings (items' terms and their counts), written to the shared folder.  From
that table come the counts over all documents (documents, length, documents
per term).  Each task then inverts its postings slab by slab and scores every
item over the slab: terms rarest first; once the bounds of the terms left
cannot reach the k-th best score so far, no accumulator is made any more, and
the documents that have one are finished exactly.  Tasks keep k documents an
item, folded by a window.

The items are a stated set that meets all documents, in blocks of
``BLOCK_BYTES`` of text, so what is broadcast is bounded however many there
are; a slab holds ``SLAB`` postings (one document at least).

Edge cases: null or termless documents count nowhere; termless items have no
result; every row is a document or item of its own, repeated ids included;
null document ids rank after the others among equal scores; ids may have any
type that sorts; texts of any length are cut into terms piece by piece; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from chronodim.llm.common import column, map_arrow, stage, table, text_bytes

K = 10
BLOCK_BYTES = 4 << 20
SLAB = 1 << 20
PIECE = 1 << 20  # bytes of a text cut into terms at a time

#: Bytes as they count in a term: digits, letters (A-Z lower-cased) and all
#: of a character outside ASCII; every other byte ends a term.
KEPT = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text, in lists of about ``PIECE`` bytes."""
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            while end < len(data) and KEPT[data[end]] != 0x20:
                end += 1
        yield data[at:end].translate(KEPT).split()
        at = end


def postings(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """id, n (terms), term (numbers, rising) and tf of each document that has
    a term at all."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    df = docs.select(column(id_col).alias("id"), text_bytes(text_col).alias("text"))
    out = StructType([df.schema["id"], StructField("n", LongType()), StructField("term", ArrayType(IntegerType())), StructField("tf", ArrayType(LongType()))])

    def run(batches):
        number = shared.value.get
        for b in batches:
            keep, size, ends, ids, tfs = [], [], [0], [], []
            for i, t in enumerate(b.column("text")):
                n, found = 0, Counter()
                for some in terms(t.as_buffer().to_pybytes()):
                    n += len(some)
                    found.update(map(number, some))
                found.pop(None, None)
                if n:
                    keep.append(i)
                    size.append(n)
                    mine = sorted(found.items())
                    ids += [k for k, _ in mine]
                    tfs += [c for _, c in mine]
                    ends.append(len(ids))
            yield pa.RecordBatch.from_arrays([
                b.column("id").take(pa.array(keep, pa.int64())), pa.array(size, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tfs, pa.int64()))], names=["id", "n", "term", "tf"])

    return map_arrow(df, run, out)


def document_counts(posts: DataFrame, size: int) -> np.ndarray:
    """Documents per term, counted per task before the shuffle."""
    def run(batches):
        n = np.zeros(size, np.int64)
        for b in batches:
            n += np.bincount(np.asarray(b.column("term").flatten()), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n).astype(np.int32)), pa.array(n[n > 0])], names=["term", "df"])

    counts = map_arrow(posts.select("term"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[np.asarray(counts.column("term"), np.int64)] = np.asarray(counts.column("df"), np.int64)
    return out


class Ranker:
    """Best k documents of each item, slab by slab.

    ``items``: for each item its (term, repeats), ``weights`` of the terms,
    ``df`` documents per term, ``total`` and ``length`` documents and terms of
    the collection."""

    def __init__(self, items: list[list[tuple[int, int]]], weights: np.ndarray, df: np.ndarray, total: int, length: int, k: int):
        self.items = [sorted(((t, q) for t, q in it if df[t] and weights[t]), key=lambda x: (df[x[0]], x[0])) for it in items]
        self.weights, self.total, self.length, self.k = weights, total, length, k
        self.best = [[] for _ in items]  # (-score, id is null, id), sorted
        self.made = self.met = 0  # accumulators made, postings met

    def add(self, ids: pa.Array, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """A slab: ids and lengths of documents, and postings (doc, term, tf)."""
        if not len(term):
            return
        sizes, back = np.unique(n, return_inverse=True)
        m = np.array([25 + 75 * int(x) * self.total // self.length for x in sizes], np.int64)[back]
        order = np.argsort(term, kind="stable")
        term, doc, tf = term[order], doc[order], tf[order]
        gain = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        there, starts = np.unique(term, return_index=True)
        ends = np.append(starts[1:], len(term))
        lists = {t: (doc[a:e], gain[a:e], int(gain[a:e].max())) for t, a, e in zip(there.tolist(), starts.tolist(), ends.tolist(), strict=True)}
        place = np.empty(len(ids), np.int64)
        place[np.asarray(pc.array_sort_indices(ids))] = np.arange(len(ids))
        score, live = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        for at, item in enumerate(self.items):
            mine = [(lists[t], q) for t, q in item if t in lists]
            if not mine:
                continue
            left = np.cumsum([q * x[2] for x, q in mine][::-1])[::-1]
            best, k = self.best[at], self.k
            reach = -best[-1][0] if len(best) == k else 1
            touched, making = [], True
            for i, ((d, g, _), q) in enumerate(mine):
                self.met += len(d)
                if making and left[i] < reach:
                    making = False
                if making:
                    new = d[~live[d]]
                    live[new] = True
                    touched.append(new)
                    score[d] += q * g
                    if i + 1 < len(mine):
                        seen = np.concatenate(touched)
                        if len(seen) >= k:
                            reach = max(reach, int(np.partition(score[seen], len(seen) - k)[len(seen) - k]))
                else:
                    old = live[d]
                    score[d[old]] += q * g[old]
            seen = np.concatenate(touched) if touched else np.zeros(0, np.int64)
            self.made += len(seen)
            good = seen[score[seen] >= reach]
            good = good[np.lexsort((place[good], -score[good]))[:k]]
            if len(good):
                found = [(-int(s), i is None, i) for s, i in zip(score[good], ids.take(pa.array(good)).to_pylist(), strict=True)]
                self.best[at] = sorted(best + found, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]
            score[seen], live[seen] = 0, False


def _slabs(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    many = np.cumsum(np.asarray(pc.list_value_length(b.column("term")), np.int64))
    at = 0
    while at < b.num_rows:
        before = many[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(many, before + SLAB, "right")))
        yield b.slice(at, end - at)
        at = end


def _joined(batches) -> Iterator[pa.RecordBatch]:
    """Batches of about ``SLAB`` postings: small ones are put together."""
    wait, size = [], 0
    for b in batches:
        n = len(b.column("term").flatten())
        if wait and size + n > SLAB:
            yield pa.Table.from_batches(wait).combine_chunks().to_batches()[0]
            wait, size = [], 0
        if b.num_rows:
            wait.append(b)
            size += n
    if wait:
        yield pa.Table.from_batches(wait).combine_chunks().to_batches()[0]


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_row, item_id, rank, doc_id, score: the k best documents of every
    row of ``items`` (``item_row`` tells rows of one item_id apart)."""
    spark = docs.sparkSession
    asked = stage(items.select(F.monotonically_increasing_id().alias("row"), column(item_col).alias("item"), text_bytes(item_text).alias("text")), "ranked-items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    out_schema = StructType([StructField("row", LongType()), asked.schema["item"], docs.select(column(id_col).alias("doc")).schema["doc"], StructField("score", LongType())])
    results = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).toArrow()
        vocabulary: dict[bytes, int] = {}
        counted = []
        for t in mine.column("text"):
            c = Counter(w for some in terms(t.as_py()) for w in some)
            counted.append([(vocabulary.setdefault(w, len(vocabulary)), q) for w, q in c.items()])
        posts = stage(postings(docs, id_col, text_col, vocabulary), "ranked-postings")
        total, length = posts.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = document_counts(posts, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        shared = spark.sparkContext.broadcast((mine.column("row").to_pylist(), mine.column("item").to_pylist(), counted, weights, df))

        def run(batches, shared=shared, total=total, length=length):
            rows, names, counted, weights, df = shared.value
            ranker = Ranker(counted, weights, df, total, length, k)
            kinds = None
            for whole in _joined(batches):
                for b in _slabs(whole):
                    kinds = b.schema.field("id").type
                    each = np.asarray(pc.list_value_length(b.column("term")), np.int64)
                    ranker.add(b.column("id"), np.asarray(b.column("n"), np.int64), np.repeat(np.arange(b.num_rows), each),
                               np.asarray(b.column("term").flatten(), np.int64), np.asarray(b.column("tf").flatten(), np.int64))
            found = [(rows[i], names[i], d, -s) for i, best in enumerate(ranker.best) for s, _, d in best]
            if found:
                r, x, d, s = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(x), pa.array(d, kinds), pa.array(s, pa.int64())], names=["row", "item", "doc", "score"])

        rank = F.row_number().over(W.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
        best = map_arrow(posts, run, out_schema).withColumn("rank", rank).where(F.col("rank") <= k)
        best = best.select(F.col("row").alias("item_row"), F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
        results.append(stage(best, "ranked") if blocks > 1 else best)
    out = results[0]
    for r in results[1:]:
        out = out.union(r)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the ten best documents of each benchmark item."""
    found = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("item_id", "rank", "doc_id", "score")
