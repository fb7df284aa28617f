import zlib

from pyspark.sql import functions as F

from chronodim.llm import shard


def test_rows_law_slots_and_digests(spark):
    r = shard.query(spark, "/root/testdata/sf0.001").collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert sorted(x.doc_id for x in r) == sorted(docs)
    slots = {}
    for x in r:
        slots.setdefault(x.shard, []).append(x.slot)
        b = (docs[x.doc_id] or "").encode()
        assert (x.size, x.text_crc32, x.law, x.grown_shard) == (len(b) + 16, zlib.crc32(b), "rows", None)
    assert set(slots) == set(range(40))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_many_buckets_nulls_repeats_and_clashing_names(spark):
    rows = [(i % 50, None if i % 7 == 0 else "x" * (i % 11), i % 3, "h", "b") for i in range(400)] + [(1, "same", 1, "h", "b")] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int, h string, record string")
    out = shard.shard(df, n_shards=7, bucket_bytes=2000).select("shard", "slot", "record.*").collect()
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(key(tuple(r)[2:]) for r in out) == sorted(map(key, rows))
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_order_is_shuffled_and_seeded(spark):
    df = spark.createDataFrame([(i, "t" * 10) for i in range(300)], "doc_id long, text string").coalesce(1)

    def order(seed):
        return [r.doc_id for r in shard.shard(df, 1, seed=seed, bucket_bytes=3000).orderBy("slot").select("record.doc_id").collect()]
    a = order(1)
    assert a == order(1) and a != order(2) and a != sorted(a)


def test_buckets_are_dealt_to_tasks_in_turn(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t" * 90).alias("text"))
    out = shard.external_shuffle(df, bucket_bytes=20_000)  # 31 buckets, 8 partitions
    assert out.count() == 4000
    plan = shard.shuffled(df.select(F.struct("*").alias("record"), F.col("doc_id").alias("ord"), F.xxhash64("doc_id").alias("h"),
                                    F.pmod("doc_id", F.lit(31)).cast("int").alias("bucket")), 8, 1)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1  # the aggregate takes the dealt partitions
    per_task = plan.select(F.spark_partition_id().alias("p"), "bucket").distinct().groupBy("p").count().collect()
    assert sorted(r["count"] for r in per_task) == [3] + [4] * 7


def test_groups_of_buckets_one_after_another(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t" * 90).alias("text"))
    out = shard.external_shuffle(df, bucket_bytes=10_000, per_task=2, max_tasks=4).collect()
    assert sorted(r.record.doc_id for r in out) == list(range(3000))
    by = {}
    for r in out:
        by.setdefault((r.bucket, r.n), []).append(r.pos)
    assert len(by) == 47 and all(sorted(v) == list(range(n)) for (_, n), v in by.items())


def test_empty(spark):
    assert shard.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "t") for i in range(20)], "doc_id long, text string")
    shard.write_shards(shard.shard(df, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["count"] for r in back.groupBy("__shard").count().collect()) == [5, 5, 5, 5]


def test_no_python_in_the_plan(spark):
    plan = shard.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
