"""SimHash near-dedup by an inverted index over byte positions.

A 64-bit fingerprint is eight bytes at eight positions.  Fingerprints that
differ in at most d = 2 bits share at least 8 - d of their positional bytes.
The index lists, for each choice of byte positions that such a pair must
share in full (two of the four aligned two-byte pieces), the distinct
fingerprints with those bytes.  Pairs that meet in a list get their shared
positional bytes counted; pairs that reach the guaranteed 8 - d are verified
by bit distance.  Lists of single bytes (256 values) would hold pairs in the
square of the input, so an entry takes four bytes at a time.

A list of over ``LIST_CAP`` fingerprints is never expanded into pairs.  Its
members meet instead under every value one bit away from them: two
fingerprints at most two bits apart have such a value in common, at most 65
fingerprints lie around one value, and all of them are within two bits of
each other, so linking each to the smallest keeps the components exact.

Only distinct fingerprints are indexed; copies are folded before any shuffle
of the index.  Edge cases: null, empty or blank texts have fingerprint zero,
which links like any other; repeated rows stay; documents with a null doc_id
take part, and a component's id is its smallest non-null doc_id; an empty
table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodim.llm.common import column, components, map_arrow, slices, stage, table, text_bytes

LIST_CAP = 32
HASH_SEED = 42


def fingerprint(text: bytes, shingle: int = 3, seed: int = HASH_SEED) -> int:
    """Signed 64-bit SimHash of the shingles of ASCII-lower-cased words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hash_ = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return int(np.uint64(hash_(joined, seed)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = np.concatenate(([0], ends[:-shingle])).tolist()
    last = (ends[shingle - 1:] - 1).tolist()
    h = np.array([hash_(joined[a:b], seed) for a, b in zip(first, last, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">u8")[0].astype(np.uint64).astype(np.int64))


def fingerprints(df: DataFrame, text_col: str = "text", shingle: int = 3, keep_text: bool = False) -> DataFrame:
    """``df``'s rows, but for the text, as struct ``row`` with their ``fp``
    and, on demand, the ``text`` as bytes."""
    src = df.select(F.struct(*[column(c) for c in df.columns if c != text_col]).alias("row"), text_bytes(text_col).alias("text"))

    def run(batches):
        for b in slices(batches):
            fps = pa.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], pa.int64())
            more = [b.column("text")] if keep_text else []
            yield pa.RecordBatch.from_arrays([b.column("row"), fps, *more], names=["row", "fp", "text"][:2 + keep_text])

    return map_arrow(src, run, T.StructType([src.schema["row"], T.StructField("fp", T.LongType()), *([src.schema["text"]] if keep_text else [])]))


def links(fps: DataFrame, max_distance: int = 2, list_cap: int = LIST_CAP) -> DataFrame:
    """Edges (hi, lo) that connect exactly the fingerprints that ``distinct``
    (fp long, each value once) links at ``max_distance`` or fewer bits."""
    if not 1 <= max_distance <= 2:
        raise ValueError("max_distance must be 1 or 2")
    pieces = [0xFFFF << (16 * p) for p in range(4)]
    masks = [sum(c) for c in combinations(pieces, 4 - max_distance)]
    signed = [int(np.uint64(m).astype(np.int64)) for m in masks]
    entries = F.array(*[F.struct(F.lit(i).alias("at"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(signed)])
    index = fps.select("fp", F.explode(entries).alias("e")).select("fp", "e.at", "e.key")
    # entries of one fingerprint only, the great majority, end here
    lists = stage(index.groupBy("at", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-lists")
    met = index.join(lists, ["at", "key"])
    short = met.where(F.col("n") <= list_cap).groupBy("at", "key").agg(F.sort_array(F.collect_list("fp")).alias("l"))
    pairs = short.select(F.explode("l").alias("lo"), "l").select("lo", F.explode(F.filter("l", lambda x: x > F.col("lo"))).alias("hi"))
    x = F.col("hi").bitwiseXOR(F.col("lo"))
    shared = sum((F.shiftrightunsigned(x, 8 * b).bitwiseAND(F.lit(255)) == 0).cast("int") for b in range(8))
    verified = pairs.where(shared >= 8 - max_distance).where(F.bit_count(x) <= max_distance).select("hi", "lo").distinct()
    long_ = met.where(F.col("n") > list_cap).select("fp").distinct()
    flips = F.array(*[F.col("fp").bitwiseXOR(F.lit(int(np.uint64(1 << b).astype(np.int64))).cast("long")) for b in range(64)])
    if max_distance == 1:
        near = long_.select(F.col("fp").alias("hi"), F.explode(flips).alias("lo")).where("hi > lo")
        return verified.union(near.join(long_, F.col("lo") == F.col("fp"), "left_semi"))
    around = long_.select("fp", F.explode(F.concat(flips, F.array("fp"))).alias("v"))
    balls = around.groupBy("v").agg(F.collect_list("fp").alias("l")).where(F.size("l") > 1)
    stars = balls.select(F.array_min("l").alias("lo"), F.explode("l").alias("hi")).where("hi <> lo").select("hi", "lo").distinct()
    return verified.union(stars)


def labels(rows: DataFrame, ident: F.Column, max_distance: int = 2, list_cap: int = LIST_CAP) -> DataFrame:
    """(f, root, component_id) for each distinct fingerprint of ``rows``."""
    distinct = stage(rows.groupBy("fp").agg(F.min(ident).alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), max_distance, list_cap), "simhash-components")
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return stage(named.join(ids, "root").select(F.col("fp").alias("f"), "root", "component_id"), "simhash-labels")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2,
                list_cap: int = LIST_CAP) -> DataFrame:
    """(row struct without the text, fp long, component_id) for every row of
    ``df``."""
    rows = stage(fingerprints(df, text_col, shingle), "simhash-rows")
    found = labels(rows, F.col("row").getField(id_col), max_distance, list_cap)
    return rows.join(found, F.col("fp") == F.col("f")).select("row", "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component of ``df``, that of the smallest id (any one
    of equal ids; null ids last), columns as they were."""
    shingle = options.pop("shingle", 3)
    rows = stage(fingerprints(df, text_col, shingle, keep_text=True).withColumn("ord", F.monotonically_increasing_id()), "simhash-texts")
    ident = F.col("row").getField(id_col)
    found = labels(rows, ident, **options)
    best = rows.select("fp", F.struct(ident.isNull().alias("a"), ident.alias("b"), "ord").alias("w")).join(found, F.col("fp") == F.col("f")) \
        .groupBy("root").agg(F.min("w").alias("w")).select(F.col("w.ord").alias("ord"))
    kept = rows.join(best, "ord", "left_semi")
    return kept.select(*[column("text").cast("string").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs).select(F.col("row.doc_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
