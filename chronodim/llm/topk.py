"""Exact top-k search by inner product: columnar branch and bound.

Candidates lie in vertical layout (one row per dimension, dimensions in
falling order of the queries' mass).  Scores accumulate one block of
dimensions at a time; after each block a pair's score can still rise by at
most the product of the remaining norms (the remaining mass).  Pairs that
can't reach their query's k-th best score so far are dropped, and the
surviving queries and candidates are compacted before the next block.

The queries are a stated set (every ``every``-th id) that meets all rows in
blocks of at most ``BLOCK_BYTES``, so what is broadcast is bounded however
many there are.  Each task keeps k candidates a query, folded by a window.

Edge cases: vectors that are null or hold null or non-finite components, and
rows with a null id, take no part; shorter vectors count as if filled up with
zeros; every row is a query or candidate of its own, also one that is equal
to another or shares its id (``query_row`` tells queries of one id apart); fewer
than k candidates give fewer rows; an empty table gives none; extra columns
are ignored.  Scores are exact while they fit 53 bits, else computed in
64-bit integers, which wrap beyond.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronodim.llm.common import column, map_arrow, stage, table

K = 5
EVERY = 50
SCALE = 256
BLOCK_BYTES = 16 << 20
DIMS = 16      # dimensions in a block
SLAB = 1024    # candidates in vertical layout at a time
QUERIES = 1024


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Integer components of a list array, one vector a line, zero-filled."""
    out = np.zeros((len(vectors), dim))
    n = np.asarray(pa.compute.list_value_length(vectors)).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    out[row, at] = np.floor(np.asarray(vectors.flatten(), np.float64) * SCALE)
    return out


class Search:
    """Best k candidates of a block of queries, slab by slab."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        """``ids``: row numbers of the queries."""
        self.ids, self.k = ids, k
        self.order = np.argsort(-np.square(q).sum(0), kind="stable")
        self.q = np.ascontiguousarray(q[:, self.order])
        self.best = [[] for _ in ids]  # (-score, vec_id), sorted
        self.reach = np.full(len(ids), -np.inf)
        tail = np.cumsum(np.square(self.q)[:, ::-1], axis=1)[:, ::-1]
        self.tail = np.sqrt(np.concatenate((tail, np.zeros((len(ids), 1))), axis=1))
        self.compared = self.finished = 0

    def add(self, vec_ids: np.ndarray, x: np.ndarray, rows_: np.ndarray | None = None) -> None:
        """Candidates by id; ``rows_`` are their row numbers, where these aren't the ids."""
        own = vec_ids if rows_ is None else rows_
        wide = np.abs(x).max(initial=0) * np.abs(self.q).max(initial=0) * max(1, x.shape[1]) >= 2.0 ** 53
        x = np.ascontiguousarray(x[:, self.order].T)  # vertical
        q = self.q
        if wide:
            x, q = x.astype(np.int64), q.astype(np.int64)
        dim = len(x)
        tail = np.cumsum(np.square(x.astype(np.float64))[::-1], axis=0)[::-1]
        tail = np.sqrt(np.concatenate((tail, np.zeros((1, x.shape[1])))))
        rows, cols = np.arange(len(q)), np.arange(x.shape[1])
        score = np.zeros((len(rows), len(cols)), x.dtype)
        self.compared += score.size
        alive = np.ones(score.shape, bool)
        for d in range(0, dim, DIMS):
            e = min(d + DIMS, dim)
            score += q[rows, d:e] @ x[d:e, cols]
            bound = score + self.tail[rows, e][:, None] * tail[e, cols][None, :]
            # rounding must not drop a pair that reaches
            bound += np.abs(bound) * 1e-9 + 0.5
            alive = bound >= self.reach[rows][:, None]
            keep_r, keep_c = alive.any(1), alive.any(0)
            if not keep_r.any():
                return
            if e < dim and keep_r.sum() * keep_c.sum() < 0.8 * alive.size:
                rows, cols = rows[keep_r], cols[keep_c]
                score, alive = score[np.ix_(keep_r, keep_c)], alive[np.ix_(keep_r, keep_c)]
        alive &= own[cols][None, :] != self.ids[rows][:, None]
        r, c = np.nonzero(alive)
        self.finished += len(r)
        s, v = score[r, c], vec_ids[cols[c]]
        by = np.lexsort((v, -s, r))
        r, s, v = r[by], s[by], v[by]
        nth = np.arange(len(r)) - np.searchsorted(r, r)
        top = nth < self.k
        for i, s_, v_ in zip(rows[r[top]].tolist(), s[top].tolist(), v[top].tolist(), strict=True):
            self.best[i].append((-int(s_), v_))
        for i in set(rows[r[top]].tolist()):
            self.best[i] = sorted(self.best[i])[:self.k]
            if len(self.best[i]) == self.k:
                self.reach[i] = -self.best[i][-1][0]


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = EVERY, k: int = K,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_row, query_id, rank, vec_id, score: the k best candidates of every query."""
    spark = df.sparkSession
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = stage(df.select(F.monotonically_increasing_id().alias("row"), column(id_col).cast("long").alias("vec_id"), column(vector_col).alias("v")), "topk-rows")
    rows = rows.withColumn("v", F.col("v").cast("array<double>")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    queries = rows.where(F.col("vec_id") % every == 0)
    n, dim = rows.agg(F.count_if(F.col("vec_id") % every == 0), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    n_blocks = max(1, math.ceil(n * (max(dim, 1) + 2) * 8 / block_bytes))
    results = []
    for block in range(n_blocks):
        mine = queries.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block).toArrow().combine_chunks()
        ids, names = (np.array(mine.column(c), np.int64) for c in ("row", "vec_id"))
        vectors = mine.column("v").combine_chunks() if mine.num_rows else pa.array([], pa.list_(pa.float64()))
        shared = spark.sparkContext.broadcast((ids, names, matrix(vectors, dim)))

        def run(batches, shared=shared):
            ids, names, q = shared.value
            parts = [Search(ids[i:i + QUERIES], q[i:i + QUERIES], k) for i in range(0, len(ids), QUERIES)]
            for b in batches:
                for at in range(0, b.num_rows, SLAB):
                    piece = b.slice(at, SLAB)
                    x = matrix(piece.column("v"), dim)
                    own, at_row = (np.array(piece.column(c), np.int64) for c in ("vec_id", "row"))
                    for p in parts:
                        p.add(own, x, at_row)
            every_best = [best for p in parts for best in p.best]
            found = [(int(i), int(name), c, -s) for i, name, best in zip(ids, names, every_best, strict=True) for s, c in best]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 4,
                                             names=["query_row", "query_id", "vec_id", "score"])

        found = map_arrow(rows, run, "query_row long, query_id long, vec_id long, score long")
        rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
        best = found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_row", "query_id", "rank", "vec_id", "score")
        results.append(stage(best, "topk") if n_blocks > 1 else best)
    out = results[0]
    for r in results[1:]:
        out = out.union(r)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the five best neighbours of every fiftieth vector."""
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("query_row")
