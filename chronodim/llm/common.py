"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronodim.plans.session import new_run_dir

# Bytes of text that a Python worker handles at a time, and that Spark sends it
# at a time.
SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared checkpoint folder and read
    it back: later plans start from files that survive a lost executor."""
    path = new_run_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with small batches, by workers that give memory back
    when a task ends (they live on for the next stages)."""
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))

    def run(batches):
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def column(name: str) -> F.Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_bytes(name: str = "text") -> F.Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(column(name).cast("binary"), F.lit(b"").cast("binary"))


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``limit`` bytes of the
    column ``text`` (one row at least)."""
    for b in batches:
        start, size = 0, 0
        lengths = pa.compute.binary_length(b.column(text)).to_pylist()
        for i, n in enumerate(lengths):
            n = n or 0
            if i > start and size + n > limit:
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        if b.num_rows > start:
            yield b.slice(start)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges`` (hi long, lo long; hi > lo) by
    alternating large-star and small-star steps.

    Returns (node, root), root the smallest node of the component, for every
    node that has an edge.  Each round is two combinable aggregations and two
    joins over the edge table, written to the shared folder; no group is
    gathered in one task and the driver sees one row of totals a round."""
    def totals(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    e = stage(edges.where("hi <> lo").distinct(), label)
    before = totals(e)
    while before[0]:
        both = e.union(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("u"), F.least("hi", "m").alias("m"))
        large = both.where("lo > hi").join(least, F.col("hi") == F.col("u")).select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "u")
        joined = large.join(least, F.col("hi") == F.col("u"))
        small = joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(least.select("u", "m")).distinct()
        e = stage(small, label)
        after = totals(e)
        if after == before:
            break
        before = after
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(e.select("lo", "lo").distinct())
