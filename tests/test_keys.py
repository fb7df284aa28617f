import datetime as dt
import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronodim.constants import UUID5_NAMESPACE
from chronodim.functions.keys import register_sql_functions, uuid5, uuid7, version_seed

NS = uuid.UUID(UUID5_NAMESPACE)

VECTORS = [
    ("cd004|2024-03-10 14:00:00", "a0ba9f85-005a-5ddb-b76d-2749f4bb969a"),
    ("cd004|2024-03-10", "03ea8242-61e9-5027-9165-cc20670aa3ad"),
    ("", "0a68eb57-c88a-5f34-9e9d-27f85e68af4f"),
    (None, "0a68eb57-c88a-5f34-9e9d-27f85e68af4f"),
]


def test_uuid5_vectors(spark):
    df = spark.createDataFrame([(s,) for s, _ in VECTORS], "s string")
    got = [r.u for r in df.select(uuid5(F.col("s")).alias("u")).collect()]
    assert got == [u for _, u in VECTORS]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=40), min_size=1, max_size=40))
def test_uuid5_matches_stdlib(spark, seeds):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seeds)], "i int, s string")
    got = {r.i: r.u for r in df.select("i", uuid5(F.col("s")).alias("u")).collect()}
    assert got == {i: str(uuid.uuid5(NS, s)) for i, s in enumerate(seeds)}


def test_version_seed_text_and_null(spark):
    df = spark.createDataFrame([("cd004", dt.datetime(2024, 3, 10, 14, 0, 0)),
                                ("cd009", dt.datetime(2024, 1, 1, 0, 0, 0, 120000)),
                                ("cd010", None)], "k string, t timestamp_ntz")
    got = [r.s for r in df.select(version_seed(["k"], "t").alias("s")).collect()]
    assert got == ["cd004|2024-03-10 14:00:00", "cd009|2024-01-01 00:00:00.12", None]


def test_uuid7_shape_order_and_time(spark):
    run = "2024-01-01 00:00:00"
    df = spark.range(2000).select(uuid7(F.lit(run).cast("timestamp")).alias("k"))
    keys = [r.k for r in df.collect()]
    assert len(set(keys)) == 2000
    ms = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    for k in keys[:50]:
        u = uuid.UUID(k)
        assert len(k) == 36 and u.version == 7 and k[19] in "89ab"
        assert int(k.replace("-", "")[:12], 16) == ms
    # a later run time sorts after an earlier one
    later = spark.range(1).select(uuid7(F.lit("2024-01-01 00:00:01").cast("timestamp")).alias("k")).first().k
    assert later > max(keys)


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT uuid5_sk('cd004|2024-03-10') AS a, uuid5_sk(NULL) AS b, uuid7() AS c").first()
    assert r.a == "03ea8242-61e9-5027-9165-cc20670aa3ad"
    assert r.b == "0a68eb57-c88a-5f34-9e9d-27f85e68af4f"
    assert uuid.UUID(r.c).version == 7


def test_keys_stay_in_codegen(spark):
    df = spark.range(10).select(uuid5(F.col("id").cast("string")).alias("a"), uuid7().alias("b"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_uuid7_ascends_in_a_task_and_differs_across_tasks(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.range(0, 40_000, 1, 5).select(F.spark_partition_id().alias("p"), "id", uuid7(now).alias("k"))
    by_task: dict = {}
    for r in df.collect():
        by_task.setdefault(r.p, []).append((r.id, r.k))
    assert len(by_task) == 5
    for rows in by_task.values():
        keys = [k for _, k in sorted(rows)]
        assert all(a < b for a, b in zip(keys, keys[1:], strict=False))
    assert len({k for rows in by_task.values() for _, k in rows}) == 40_000
    # generated for some rows only, the counters of a key still agree
    some = spark.range(0, 1000, 1, 1).select("id", F.when(F.col("id") % 3 == 0, F.coalesce(F.lit(None).cast("string"), uuid7(now))).alias("k")).where("k is not null")
    keys = [r.k for r in some.orderBy("id").collect()]
    assert len(keys) == 334 and all(a < b for a, b in zip(keys, keys[1:], strict=False))
    assert [int(k.replace("-", "")[13:16], 16) << 12 | (int(k[19:23], 16) & 0x3FFC) >> 2 for k in keys] == list(range(334))


def test_uuid7_counter_that_runs_over_adds_a_millisecond(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    n = (1 << 24) + 3
    k = spark.range(0, n, 1, 1).select("id", uuid7(now).alias("k")).where(F.col("id") >= n - 5).orderBy("id").collect()
    ms = [int(r.k.replace("-", "")[:12], 16) for r in k]
    assert ms == [ms[0]] * 2 + [ms[0] + 1] * 3 and [r.k for r in k] == sorted(r.k for r in k)
