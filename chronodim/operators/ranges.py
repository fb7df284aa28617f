"""Key ranges: range bounds cut from counted bytes, a row's range, and writes
that replace only the ranges they touch.

A state table is plain Parquet partitioned by ``_range``.  Ranges are ordered
like the keys; a write range-partitions its rows by (range, key) into as many
tasks as their bytes ask for, so a range that has grown is written by several
tasks and a few small ranges by one, and all files hold disjoint key ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RANGE = "_range"
RANGE_BYTES = 128 * 1024 * 1024   # of rows in a range when it is cut
TASK_BYTES = 32 * 1024 * 1024     # that a task writes, about: it sorts them, and those of files are compressed
MAX_RANGES = 1024
FILTER_SIZES = 14  # sizes a Bloom filter is chosen from: 1 MB, halved each time


def cut_bounds(df: DataFrame, keys: Sequence[str], size: int, ranges: int | None = None) -> list[list[str]]:
    """Lower bounds (as text) of the key ranges after the first, from a range
    partitioning of the keys: about ``RANGE_BYTES`` each of ``size`` bytes, or
    ``ranges`` of them.  At most ``MAX_RANGES`` rows reach the driver."""
    n = ranges or min(MAX_RANGES, math.ceil(size / RANGE_BYTES))
    if n <= 1:
        return []
    least = df.select(*keys).repartitionByRange(n, *keys).groupBy(F.spark_partition_id()).agg(F.min(F.struct(*keys)).alias("k")).select("k").distinct()
    rows = least.orderBy("k").select(*[F.col(f"k.{k}").cast("string").alias(k) for k in keys]).collect()
    return [list(r) for r in rows[1:]]


def range_of(bounds: Sequence[Sequence[str]], keys: Sequence[str], schema: StructType) -> Column:
    """Range of a row: how many bounds its key reaches, found by a binary
    search written as nested CASE (log2 comparisons a row)."""
    key = F.struct(*[F.col(k) for k in keys])

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        bound = F.struct(*[F.lit(x).cast(schema[k].dataType).alias(k) for x, k in zip(bounds[mid], keys, strict=True)])
        return F.when(key < bound, search(low, mid)).otherwise(search(mid + 1, high))

    return search(0, len(bounds))


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files that hold the rows of ``df`` (a filtered read of a
    file table); no data column is read."""
    files = df.groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("b"))
    return files.agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]


def sized(df: DataFrame, by: Sequence[str], size: int) -> DataFrame:
    """``df`` ordered by ``by`` in as many tasks as ``size`` bytes ask for;
    tasks hold disjoint ranges.  Always a shuffle, so that the one task of a small
    table sorts its rows only: the joins and aggregates of ``df`` stay in tasks of
    their own."""
    n = max(1, math.ceil(size / TASK_BYTES))
    laid = df.repartition(1) if n == 1 else df.repartitionByRange(n, *by)
    return laid.sortWithinPartitions(*by)


def key_filters(writer: DataFrameWriter, keys: Sequence[str]) -> DataFrameWriter:
    """``writer`` with Parquet Bloom filters on ``keys``, sized by the values a
    row group holds: a lookup by key skips row groups whose least and greatest
    key enclose it but that do not hold it."""
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true").option(f"parquet.bloom.filter.candidates.number#{k}", FILTER_SIZES)
    return writer


def overwrite_ranges(df: DataFrame, path: str, keys: Sequence[str], size: int) -> None:
    """Write ``df`` (with ``_range``) to the table at ``path``, replacing just
    the ranges it holds (dynamic partition overwrite).  ``df`` may read the
    ranges it replaces: files are swapped after all tasks have ended."""
    w = sized(df, [RANGE, *keys], size).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    key_filters(w, keys).partitionBy(RANGE).parquet(path)


def read_ranges(spark: SparkSession, path: str, schema: StructType, ranges: Sequence[int] | None = None) -> DataFrame:
    """The table at ``path`` with the columns of ``schema`` (``_range``
    included), or just some of its ranges."""
    df = spark.read.schema(schema).parquet(path)
    return df if ranges is None else df.where(F.col(RANGE).isin([int(r) for r in ranges]))
