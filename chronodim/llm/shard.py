"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters whole records uniformly into buckets small enough for memory
by a seeded hash; pass 2 loads one bucket at a time, Fisher-Yates shuffles it
(``shuffle``) and writes it.  Positions then run through the buckets in order
and are dealt to the shards in turn, so shard counts differ by one at most.

Buckets are dealt to tasks in turn, at most ``PER_TASK`` each.  Where that
takes more than ``MAX_TASKS`` tasks, records are first written by group of
buckets, and the groups are scattered and shuffled one after another, so no
shuffle has more partitions, whatever the input.

Edge cases: null or empty texts are records like any other; repeated rows are
records of their own and spread over the buckets (the hash takes the record's
ordinal too, so one row repeated many times fills no single bucket); an empty
table gives no rows; extra columns travel along untouched, also under names
used here.  The input should be a table (files), so that a lost task scatters
its records again as it did before.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from chronodim.llm.common import column, stage, table
from chronodim.plans.session import broadcast_if_small, new_run_dir

SEED = 20240607
BUCKET_BYTES = 16 << 20
N_SHARDS = 40
PER_TASK = 8      # buckets of a task
MAX_TASKS = 8192  # partitions of a shuffle


def external_shuffle(df: DataFrame, text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
                     total_bytes: int | None = None, per_task: int = PER_TASK, max_tasks: int = MAX_TASKS) -> DataFrame:
    """All records of ``df`` in a seeded random order: (bucket int, pos long,
    n long, record struct), written to the shared folder.  ``pos`` counts from
    0 within the bucket, ``n`` is the bucket's count."""
    if total_bytes is None:
        total_bytes = df.agg(F.sum(F.coalesce(F.octet_length(column(text_col)), F.lit(0)) + 64)).first()[0] or 0
    # small inputs still get a bucket for each of the session's partitions
    n_buckets = max(math.ceil(total_bytes / bucket_bytes), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n_tasks = max(min(n_buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), math.ceil(n_buckets / per_task))
    rec = df.select(F.struct(*[column(c) for c in df.columns]).alias("record"))
    rec = rec.select("record", F.monotonically_increasing_id().alias("ord"))
    rec = rec.select("record", F.xxhash64(F.lit(seed), F.col(f"record.`{text_col}`"), "ord").alias("h"), "ord")
    rec = rec.withColumn("bucket", F.pmod("h", F.lit(n_buckets)).cast("int"))
    if n_tasks <= max_tasks:
        return stage(shuffled(rec, n_tasks, seed), "shuffled")
    group_buckets = max_tasks * per_task
    path = new_run_dir(df.sparkSession, "scattered")
    rec.withColumn("group", F.floor(F.col("bucket") / group_buckets).cast("int")).write.partitionBy("group").parquet(path)
    rec = df.sparkSession.read.schema(StructType([*rec.schema.fields, StructField("group", IntegerType())])).parquet(path)
    groups = [shuffled(rec.where(F.col("group") == g).drop("group"), max_tasks, seed) for g in range(math.ceil(n_buckets / group_buckets))]
    out = new_run_dir(df.sparkSession, "shuffled")
    for g in groups:
        g.write.mode("append").parquet(out)
    return df.sparkSession.read.schema(groups[0].schema).parquet(out)


def shuffled(rec: DataFrame, n_tasks: int, seed: int) -> DataFrame:
    """Each bucket of ``rec`` (record, ord, h, bucket) in Fisher-Yates order."""
    # pass 1: scatter.  Sorted input gives the aggregate its buckets, and each
    # bucket its records, in one fixed order, so the seeded swaps repeat.
    rec = rec.withColumn("task", F.pmod("bucket", F.lit(n_tasks)).cast("int"))
    scattered = rec.repartitionById(n_tasks, F.col("task")).sortWithinPartitions("task", "bucket", "h", "ord")
    # pass 2: a task's few buckets in memory, Fisher-Yates
    buckets = scattered.groupBy("task", "bucket").agg(F.collect_list("record").alias("records"))
    dealt = buckets.select("bucket", F.size("records").cast("long").alias("n"),
                           F.posexplode(F.shuffle("records", F.lit(seed))).alias("pos", "record"))
    return dealt.select("bucket", F.col("pos").cast("long").alias("pos"), "n", "record")


def shard(df: DataFrame, n_shards: int = N_SHARDS, text_col: str = "text", seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(shard int, slot long, record struct) for every record of ``df``."""
    out = external_shuffle(df, text_col, seed, bucket_bytes)
    # one row a bucket; broadcast, or the records would be shuffled again
    ends = out.groupBy("bucket").agg(F.first("n").alias("n_b"))
    starts = ends.select(F.col("bucket").alias("b"), (F.sum("n_b").over(W.orderBy("bucket")) - F.col("n_b")).alias("start"))
    starts = broadcast_if_small(stage(starts, "shuffle-starts"))
    at = F.col("start") + F.col("pos")
    return out.join(starts, F.col("bucket") == F.col("b")).select(
        F.pmod(at, F.lit(n_shards)).cast("int").alias("shard"), F.floor(at / n_shards).cast("long").alias("slot"), "record")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the records as ``path/shard=<n>/``, in slot order within a file."""
    sharded.select("record.*", F.col("shard").alias("__shard"), F.col("slot").alias("__slot")) \
        .repartition("__shard").sortWithinPartitions("__shard", "__slot") \
        .write.partitionBy("__shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: all documents in shards 0 to 39 under the law ``rows``."""
    text = F.col("record.text")
    return shard(table(spark, sf_dir, "documents")).select(
        F.col("record.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text.cast("binary"), F.lit(b"").cast("binary"))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
