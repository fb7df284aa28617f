"""The store keeps what it is given: zones, deferred marts, schemas of old
versions, empty runs, touched key ranges only, full refresh."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from chronodim.constants import SOURCE_TS
from chronodim.operators.checks import duplicate_groups, file_overlaps, key_idempotence
from chronodim.operators.dedupe import latest_per_key
from chronodim.operators.gold import compare_dimensions
from chronodim.operators.ingest import accepted_changes, bronze_ingest, to_bronze_rows
from chronodim.operators.keyfilter import key_filter, may_hold
from chronodim.operators.maintenance import overwrite_via_staging, patch_from_frame
from chronodim.operators.scd import scd2_apply, scd2_close, scd2_new_versions
from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import new_run_dir
from chronodim.sources.feeds import EVENTS, ORDERS
from chronodim.sources.seed import land_seed, write_csv_seed

DDL = "k string, name string, t timestamp_ntz"


def rows(spark, data, ddl=DDL):
    return spark.createDataFrame([(k, n, None if t is None else dt.datetime.fromisoformat(t)) for k, n, t in data], ddl)


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_watermark_survives_a_change_of_session_zone(spark):
    zoned = "k string, name string, t timestamp"
    st = DimensionStore(spark, new_run_dir(spark, "zone"), ["k"], "t")
    st.apply(spark.sql("SELECT 'a' k, 'x' name, TIMESTAMP '2024-01-01 12:00:00Z' t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Mexico_City")
        raw = spark.sql("SELECT * FROM VALUES ('b', 'n', TIMESTAMP '2024-01-01 12:30:00Z'), ('c', 'm', TIMESTAMP '2024-01-01 15:00:00Z') AS t(k, name, t)")
        again = DimensionStore.open(spark, st.root)
        spark.conf.set("spark.sql.session.timeZone", "America/Mexico_City")
        again.apply(raw)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert values(again.bronze(), "k") == [("a",), ("b",), ("c",)]
    assert zoned


def test_marts_built_once_after_several_runs(spark):
    st = DimensionStore(spark, new_run_dir(spark, "later"), ["k"], "t", attrs=["name"], key_ranges=3)
    st.apply(rows(spark, [("a", "1", "2024-01-01"), ("b", "1", "2024-01-01")]))
    st.apply(rows(spark, [("a", "2", "2024-01-02"), ("c", "1", "2024-01-02")]), build_gold=False)
    st.apply(rows(spark, [("a", "3", "2024-01-03"), ("c", "2", "2024-01-03")]), build_gold=False)
    st.build_gold()
    full = compare_dimensions(st.scd1(), st.scd2(), ["k"], ["name"])
    cols = [c for c in full.columns if c != "_gold_created_at"]
    assert values(st.gold_comparison(), *cols) == values(full, *cols)
    assert values(st.gold_comparison(), "k", "scd2_total_versions", "has_history") == [("a", 3, True), ("b", 1, False), ("c", 2, True)]
    assert st.gold_history().count() == st.scd2().count() == 6


def test_old_versions_keep_their_columns(spark):
    st = DimensionStore(spark, new_run_dir(spark, "cols"), ["k"], "t")
    st.apply(rows(spark, [("a", "x", "2024-01-01")]))
    st.apply(rows(spark, [("b", "y", "2024-01-02")]).drop("name"))
    assert "name" not in st.bronze().columns
    assert values(st.bronze(0), "k", "name") == values(st.bronze_as_of(0), "k", "name") == [("a", "x")]


def test_empty_runs_are_commits(spark):
    st = DimensionStore(spark, new_run_dir(spark, "none"), ["k"], "t")
    st.apply(rows(spark, []))
    st.apply(rows(spark, [("a", "x", "2024-01-01")]))
    st.apply(rows(spark, []))
    got = [(c.snapshot_id, c.operation, c.summary["added-records"]) for c in st.commits().collect()]
    assert got == [(0, "append", "0"), (1, "overwrite", "1"), (2, "overwrite", "0")]
    assert st.bronze().count() == st.scd1().count() == st.scd2().count() == st.gold_comparison().count() == 1
    assert st.bronze(0).count() == 0


def test_a_run_writes_only_the_key_ranges_it_touches(spark):
    root = new_run_dir(spark, "parts")
    st = DimensionStore(spark, root, ["k"], "t", attrs=["name"], key_ranges=8)
    st.apply(rows(spark, [(f"k{i:03d}", "x", "2024-01-01") for i in range(200)]))
    def files(table):
        return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root.replace('file:', '')}/_base=0/{table}/_range=*/*.parquet")}

    tables = ("bronze", "scd1", "scd2_open", "gold_comparison")
    for batch in ([("k003", "y", "2024-01-02"), ("k004", "y", "2024-01-02")], [("k199", "z", "2024-01-03"), ("k999", "z", "2024-01-03")]):
        before = {t: files(t) for t in tables}
        st.apply(rows(spark, batch))
        for t in tables:  # one range of eight was replaced
            assert len(before[t]) == 8 and len(before[t].items() & files(t).items()) == 7, t
    whole = DimensionStore(spark, new_run_dir(spark, "whole"), ["k"], "t", attrs=["name"], key_ranges=1)
    whole.apply(rows(spark, [(f"k{i:03d}", "x", "2024-01-01") for i in range(200)]))
    whole.apply(rows(spark, [("k003", "y", "2024-01-02"), ("k004", "y", "2024-01-02")]))
    whole.apply(rows(spark, [("k199", "z", "2024-01-03"), ("k999", "z", "2024-01-03")]))
    for a, b, cols in ((st.bronze(), whole.bronze(), ("k", "name")), (st.scd2(), whole.scd2(), ("sk_name", "k", "valid_from_sk", "is_current")),
                       (st.gold_comparison(), whole.gold_comparison(), ("k", "scd2_total_versions", "scd2_first_version", "scd2_latest_version")),
                       (st.bronze(1), whole.bronze(1), ("k", "name"))):
        assert values(a, *cols) == values(b, *cols)
    assert st.scd1().select("sk_name").distinct().count() == 201
    for df in (st.scd1(), st.scd2_current(), st.bronze()):
        r = file_overlaps(df, ["k"]).first()
        assert r.n_rows == 201 and r.overlapping_files == 0


def test_file_overlaps_sees_unclustered_files(spark):
    path = new_run_dir(spark, "mixed")
    spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(4).write.parquet(path)
    assert file_overlaps(spark.read.parquet(path), ["k"]).first().overlapping_files == 3


def test_full_refresh(spark):
    st = DimensionStore(spark, new_run_dir(spark, "refresh"), ["k"], "t", attrs=["name"])
    st.apply(rows(spark, [("a", "1", "2024-01-01"), ("gone", "1", "2024-01-01")]))
    st.apply(rows(spark, [("a", "2", "2024-01-02")]))
    old = st.scd2().select("sk_name", "k", "valid_from_sk")
    st.full_refresh(rows(spark, [("a", "2", "2024-01-02"), ("b", "1", "2023-06-01")]))
    assert values(st.bronze(), "k", "name") == [("a", "2"), ("b", "1")]
    assert values(st.scd2(), "k", "is_current") == [("a", True), ("b", True)]
    assert values(st.gold_comparison(), "k", "scd2_total_versions") == [("a", 1), ("b", 1)]
    assert st.scd2(1).count() == 3  # earlier commits stay readable
    new = {r.k: r.sk_name for r in st.scd2().collect()}
    assert new["a"] in {r.sk_name for r in old.collect()}
    st.apply(rows(spark, [("b", "2", "2024-02-01")]))
    assert values(st.scd2(), "k", "is_current") == [("a", True), ("b", False), ("b", True)]


def test_key_idempotence_can_fail(spark):
    a = rows(spark, [("a", "sk1", "2024-01-01"), ("b", "sk2", "2024-01-01")]).toDF("k", "sk_name", "valid_from_sk")
    b = rows(spark, [("a", "sk1", "2024-01-01"), ("b", "other", "2024-01-01"), ("c", "sk3", "2024-01-01")]).toDF("k", "sk_name", "valid_from_sk")
    assert tuple(key_idempotence(a, a, ["k"]).first()) == (2, 2, 0)
    assert key_idempotence(a, b, ["k"]).first().unstable_rows == 2


def test_late_is_judged_per_key_on_demand(spark):
    state = bronze_ingest(rows(spark, [("a", "x", "2024-01-05"), ("b", "x", "2024-01-01")]), None, ["k"], "t")
    batch = rows(spark, [("c", "new key below the maximum", "2024-01-02"), ("b", "newer", "2024-01-03"), ("a", "older", "2024-01-04"), ("d", "none", None)])
    assert values(accepted_changes(batch, state, ["k"], "t", late="key"), "k") == [("b",), ("c",)]
    st = DimensionStore(spark, new_run_dir(spark, "perkey"), ["k"], "t", late="key")
    for k, t in (("a", "2024-01-05"), ("b", "2024-01-01"), ("c", "2024-01-03")):
        st.apply(rows(spark, [(k, "x", t)]))
    assert values(st.bronze(), "k") == values(st.scd1(), "k") == values(st.scd2(), "k") == [("a",), ("b",), ("c",)]
    assert str(st.watermark().first().watermark) == "2024-01-05 00:00:00"


def test_state_keys_are_pruned_before_the_late_join(spark):
    state = spark.range(20000).select(F.col("id").cast("string").alias("k"), F.lit("2024-01-05").cast("timestamp_ntz").alias(SOURCE_TS))
    batch = rows(spark, [("7", "older", "2024-01-04"), ("8", "newer", "2024-01-06"), ("x", "unknown", "2024-01-01"), (None, "no key", "2024-01-01")])
    typed = to_bronze_rows(batch, "t").where(F.col(SOURCE_TS).isNotNull())
    left = may_hold(state, key_filter(typed, ["k"]), ["k"])
    kept = {r.k for r in left.collect()}
    assert {"7", "8"} <= kept and len(kept) < 20
    full = {r.k for r in state.collect()}
    few = may_hold(state, key_filter(state.where("k % 3 = 0"), ["k"], words=4), ["k"], words=4)  # saturated: all pass, none is lost
    assert {r.k for r in few.collect()} >= {k for k in full if int(k) % 3 == 0}
    out = accepted_changes(batch, state, ["k"], "t", late="key")
    assert sorted((r.k or "", r.name) for r in out.collect()) == [("", "no key"), ("8", "newer"), ("x", "unknown")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "bit_or" in plan
    ints = state.select(F.col("k").cast("int").alias("k"), SOURCE_TS)  # other type: joined without the filter
    longs = batch.where("k in ('7', '8')").withColumn("k", F.col("k").cast("long"))
    out = accepted_changes(longs, ints, ["k"], "t", late="key")
    assert [r.k for r in out.collect()] == [8] and "bit_or" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_late_per_key_reads_the_batch_ranges_only(spark):
    st = DimensionStore(spark, new_run_dir(spark, "lateranges"), ["k"], "t", late="key", key_ranges=4)
    st.apply(rows(spark, [(f"k{i:03d}", "x", "2024-01-05") for i in range(100)]))
    asked, read = [], st._state
    st._state = lambda table, run, ranges=None: (asked.append((table, ranges)), read(table, run, ranges))[1]
    st.apply(rows(spark, [("k001", "older", "2024-01-04"), ("k002", "newer", "2024-01-06")]))
    assert ("bronze", [0]) in asked
    got = {r.k: r.name for r in st.bronze().collect()}
    assert len(got) == 100 and got["k001"] == "x" and got["k002"] == "newer"


def test_duplicates_can_be_an_error(spark):
    st = DimensionStore(spark, new_run_dir(spark, "dup"), ["k"], "t", on_duplicate="error")
    st.apply(rows(spark, [("a", "x", "2024-01-01")]))
    with pytest.raises(ValueError, match="several changes"):
        st.apply(rows(spark, [("a", "y", "2024-01-02"), ("a", "z", "2024-01-03")]))


def test_null_change_times_lie_in_the_last_batch(spark):
    for spec, ddl in ((EVENTS, "user_id long, ts timestamp_ntz"), (ORDERS, "o_orderkey long, o_orderdate timestamp_ntz")):
        df = spark.createDataFrame([(1, None), (10, None)], ddl)
        per = [df.where(spec.in_batch(n)).count() for n in range(spec.n_batches)]
        assert per == [0] * (spec.n_batches - 1) + [2]
        assert df.select(spec.batch().alias("b")).distinct().collect()[0].b == spec.n_batches - 1


def test_two_forms_of_type_2_agree_on_several_changes(spark):
    s0 = scd2_apply(bronze_ingest(rows(spark, [("a", "x", "2024-01-01")]), None, ["k"], "t"), None, ["k"])
    chg = bronze_ingest(rows(spark, [("a", "1", "2024-01-02"), ("a", "2", "2024-01-03"), ("n", "1", "2024-01-02"), ("n", "2", "2024-01-03")]), None, ["k"], "t", on_duplicate="keep")
    closed = scd2_close(s0, chg, ["k"])
    two = closed.unionByName(scd2_new_versions(chg, closed, ["k"]))
    cols = [c for c in two.columns if c != "_silver_created_at"]
    assert values(two, *cols) == values(scd2_apply(chg, s0, ["k"]), *cols)


def test_latest_per_key_takes_map_columns(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, map('x', 1)), ('a', 2, map('y', 2)) AS t(k, v, m)")
    assert [r.m for r in latest_per_key(df, ["k"], ["v"]).collect()] == [{"y": 2}]


def test_staged_overwrite_never_leaves_no_table(spark):
    base = new_run_dir(spark, "swap")
    spark.range(3).write.parquet(f"{base}/t")
    with pytest.raises(Exception, match="."):  # the new rows fail: the target stays
        overwrite_via_staging(spark.read.parquet(f"{base}/t").select(F.raise_error(F.lit("bad")).cast("long").alias("id")), f"{base}/t", f"{base}/s1")
    assert spark.read.parquet(f"{base}/t").count() == 3
    assert overwrite_via_staging(spark.range(5), f"{base}/t", f"{base}/s2").count() == 5
    assert overwrite_via_staging(spark.range(6), f"{base}/new", f"{base}/s3").count() == 6


def test_patch_never_multiplies_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    patch = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    assert values(patch_from_frame(df, "k", patch), "k", "v") == [(1, "y"), (2, "b")]


def test_seed_text_round_trip(spark):
    base = new_run_dir(spark, "text")
    data = [(1, 'a "quoted", text\nwith lines\n\nand commas,'), (2, ""), (3, None), (4, "  blanks  "), (5, '""'), (6, "back\\slash\\")]
    write_csv_seed(spark.createDataFrame(data, "k int, v string"), f"{base}/csv")
    assert values(land_seed(spark, f"{base}/csv", f"{base}/t", "k int, v string").where("k <> 3"), "k", "v") == sorted((k, v) for k, v in data if k != 3)
    assert spark.read.parquet(f"{base}/t").where("v is null").count() == 1


def test_duplicate_texts_are_found_by_digest_and_compared(spark):
    df = spark.createDataFrame([("x" * 5000,), ("x" * 5000,), ("y",), (None,), (None,)], "v string")
    assert [(r.v, r.n) for r in duplicate_groups(df, ["v"]).collect()] == [("x" * 5000, 2)]
    first = duplicate_groups(df, ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in first
