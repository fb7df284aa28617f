"""Edge cases: ties and late rows, duplicates in a batch, NULL change times,
identical attributes, sub-second times, schema policies, empty inputs."""

import pytest
from pyspark.sql import functions as F

from chronodim.operators.ingest import accepted_changes, bronze_ingest
from chronodim.operators.merge import upsert
from chronodim.operators.scd import scd1_apply, scd2_apply, scd2_close, scd2_new_versions
from chronodim.operators.schema import evolve
from chronodim.operators.checks import scd2_violations
from chronodim.operators.watermark import high_watermark, late_rows
from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import new_run_dir

DDL = "k string, name string, t timestamp_ntz"


def rows(spark, data):
    return spark.createDataFrame(
        [(k, n, None if t is None else __import__("datetime").datetime.fromisoformat(t)) for k, n, t in data], DDL)


def table(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_watermark_tie_and_late_rows(spark):
    st = bronze_ingest(rows(spark, [("a", "x", "2024-01-02 00:00:00"), ("b", "y", "2024-01-01 00:00:00")]),
                       None, ["k"], "t")
    batch = rows(spark, [("c", "tie", "2024-01-02 00:00:00"),     # equal to the watermark: skipped
                         ("d", "late", "2024-01-01 12:00:00"),    # new key below the watermark: skipped
                         ("b", "new", "2024-01-03 00:00:00"),
                         ("e", "nul", None)])                     # no change time: skipped
    acc = accepted_changes(batch, st, ["k"], "t")
    assert table(acc, "k", "name") == [("b", "new")]
    assert table(late_rows(batch, st, ts="t"), "k") == [("c",), ("d",), ("e",)]
    assert high_watermark(st).first().watermark.isoformat() == "2024-01-02T00:00:00"


def test_empty_state_watermark_default(spark):
    empty = bronze_ingest(rows(spark, []), None, ["k"], "t")
    assert str(high_watermark(empty).first().watermark) == "1900-01-01 00:00:00"
    acc = accepted_changes(rows(spark, [("a", "x", "2024-01-01 00:00:00")]), empty, ["k"], "t")
    assert acc.count() == 1


def test_duplicates_in_batch(spark):
    st = bronze_ingest(rows(spark, [("a", "x", "2024-01-01 00:00:00")]), None, ["k"], "t")
    batch = rows(spark, [("a", "a1", "2024-02-01 00:00:00"), ("a", "a2", "2024-02-02 00:00:00"),
                         ("n", "n1", "2024-02-05 00:00:00"), ("n", "n2", "2024-02-03 00:00:00")])
    out = bronze_ingest(batch, st, ["k"], "t")
    assert table(out, "k", "name") == [("a", "a2"), ("n", "n1")]
    # first run without merge keeps duplicates only when asked to
    assert bronze_ingest(batch, None, ["k"], "t", on_duplicate="keep").count() == 4
    assert bronze_ingest(batch, None, ["k"], "t").count() == 2


def test_tiebreak_on_equal_times(spark):
    df = spark.createDataFrame([("a", 1, "2024-01-01"), ("a", 3, "2024-01-01"), ("a", 2, "2024-01-01")],
                               "k string, ok int, t string")
    out = bronze_ingest(df, None, ["k"], "t", tiebreak=["ok"])
    assert [r.ok for r in out.collect()] == [3]


def test_null_change_time(spark):
    b0 = rows(spark, [("a", "x", None), ("b", "y", "2024-01-01 00:00:00")])
    st = bronze_ingest(b0, None, ["k"], "t")
    assert st.count() == 2                      # first run lets a NULL time through
    b1 = rows(spark, [("a", "x2", None)])
    assert accepted_changes(b1, st, ["k"], "t").count() == 0


def test_identical_attributes_newer_time_is_new_version(spark):
    s0 = scd2_apply(bronze_ingest(rows(spark, [("a", "x", "2024-01-01 00:00:00")]), None, ["k"], "t"),
                    None, ["k"])
    chg = bronze_ingest(rows(spark, [("a", "x", "2024-01-02 00:00:00")]), None, ["k"], "t")
    s1 = scd2_apply(chg, s0, ["k"])
    assert s1.count() == 2 and s1.where("is_current").count() == 1


def test_older_change_is_ignored_by_type2(spark):
    s0 = scd2_apply(bronze_ingest(rows(spark, [("a", "x", "2024-01-05 00:00:00")]), None, ["k"], "t"),
                    None, ["k"])
    old = bronze_ingest(rows(spark, [("a", "old", "2024-01-01 00:00:00")]), None, ["k"], "t")
    s1 = scd2_apply(old, s0, ["k"])
    assert table(s1, "name", "is_current") == [("x", True)]


def test_close_then_append_equals_apply(spark):
    s0 = scd2_apply(bronze_ingest(rows(spark, [("a", "x", "2024-01-01 00:00:00"),
                                                 ("b", "y", "2024-01-01 00:00:00")]), None, ["k"], "t"), None, ["k"])
    chg = bronze_ingest(rows(spark, [("a", "x2", "2024-01-03 00:00:00"), ("c", "z", "2024-01-03 00:00:00"),
                                     ("b", "old", "2023-12-01 00:00:00")]), None, ["k"], "t")
    closed = scd2_close(s0, chg, ["k"])
    two_step = closed.unionByName(scd2_new_versions(chg, closed, ["k"]))
    one_step = scd2_apply(chg, s0, ["k"])
    cols = [c for c in one_step.columns if c != "_silver_created_at"]
    assert table(two_step, *cols) == table(one_step, *cols)


def test_subsecond_and_non_ascii_keys(spark):
    df = spark.createDataFrame(
        [("ñandú", "a", "2024-01-01 10:00:00.5"), ("日本", "b", "2024-01-01 10:00:00.000001")],
        "k string, name string, t string")
    s = scd2_apply(bronze_ingest(df, None, ["k"], "t"), None, ["k"])
    import uuid
    ns = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")
    got = {r.k: r.sk_name for r in s.collect()}
    assert got == {"ñandú": str(uuid.uuid5(ns, "ñandú|2024-01-01 10:00:00.5")),
                   "日本": str(uuid.uuid5(ns, "日本|2024-01-01 10:00:00.000001"))}


def test_schema_policies(spark):
    st = bronze_ingest(rows(spark, [("a", "x", "2024-01-01 00:00:00"), ("b", "y", "2024-01-01 00:00:00")]),
                       None, ["k"], "t")
    b1 = spark.createDataFrame([("a", "2024-02-01 00:00:00", "red")], "k string, t string, color string")
    chg = accepted_changes(b1, st, ["k"], "t")
    s, c = evolve(st, chg, "sync_all_columns")
    synced = upsert(s, c, ["k"])
    assert "color" in synced.columns and "name" not in synced.columns
    assert table(synced, "k", "color") == [("a", "red"), ("b", None)]
    s, c = evolve(st, chg, "ignore")
    kept = upsert(s, c, ["k"])
    assert "color" not in kept.columns
    assert table(kept, "k", "name") == [("a", None), ("b", "y")]
    with pytest.raises(ValueError):
        evolve(st, chg, "append_new_columns")


def test_scd1_apply_keeps_keys_and_policies(spark):
    b0 = bronze_ingest(rows(spark, [("a", "x", "2024-01-01 00:00:00")]), None, ["k"], "t")
    s0 = scd1_apply(b0, None, ["k"]).cache()
    sk = s0.first().sk_name
    b1 = bronze_ingest(rows(spark, [("a", "x2", "2024-01-02 00:00:00"), ("z", "n", "2024-01-02 00:00:00")]),
                       None, ["k"], "t")
    s1 = {r.k: r for r in scd1_apply(b1, s0, ["k"]).collect()}
    assert s1["a"].sk_name == sk and s1["a"].name == "x2" and s1["z"].sk_name != sk
    s0.unpersist()


def test_type2_schema_ignore_in_store(spark):
    st = DimensionStore(spark, new_run_dir(spark, "ign"), ["k"], "t")
    st.apply(rows(spark, [("a", "x", "2024-01-01 00:00:00")]), "2024-01-01 01:00:00")
    b1 = spark.createDataFrame([("a", "x2", "2024-02-01 00:00:00", "red")], "k string, name string, t string, color string")
    st.apply(b1.withColumn("t", F.col("t").cast("timestamp_ntz")), "2024-02-01 01:00:00")
    assert "color" not in st.scd2().columns          # type 2 ignores new columns
    assert "color" in st.scd1().columns and "color" in st.bronze().columns  # the others follow the source
    assert st.scd2().count() == 2


def test_empty_change_set(spark):
    st = DimensionStore(spark, new_run_dir(spark, "empty"), ["k"], "t")
    st.apply(rows(spark, [("a", "x", "2024-01-01 00:00:00")]), "2024-01-01 01:00:00")
    st.apply(rows(spark, []), "2024-01-02 01:00:00")
    assert st.bronze().count() == 1 and st.scd1().count() == 1 and st.scd2().count() == 1
    assert st.version == 1 and st.log().count() == 1


def test_quarantine_bad_casts(spark):
    raw = spark.createDataFrame([("a", "x", "2024-01-01", "2024-01-01 10:00:00"),
                                 ("b", "y", "not a date", "2024-01-01 10:00:00"),
                                 ("c", "z", "2024-01-02", "yesterday")],
                                "k string, name string, d string, t string")
    st = DimensionStore(spark, new_run_dir(spark, "quar"), ["k"], "t", casts={"d": "date"},
                        on_bad_cast="quarantine")
    st.apply(raw, "2024-01-03 00:00:00")
    assert table(st.bronze(), "k") == [("a",)]
    q = {r.k: list(r._bad_columns) for r in st.quarantine().collect()}
    assert q == {"b": ["d"], "c": ["t"]}
    strict = DimensionStore(spark, new_run_dir(spark, "strict"), ["k"], "t", casts={"d": "date"})
    with pytest.raises(Exception):
        strict.apply(raw, "2024-01-03 00:00:00")


def test_store_reopens_from_folder(spark):
    root = new_run_dir(spark, "reopen")
    st = DimensionStore(spark, root, ["k"], "t", attrs=["name"])
    st.apply(rows(spark, [("a", "x", "2024-01-01 00:00:00"), ("b", "y", "2024-01-01 00:00:00")]),
             "2024-01-01 01:00:00")
    st.apply(rows(spark, [("a", "x2", "2024-01-02 00:00:00")]), "2024-01-02 01:00:00")
    again = DimensionStore.open(spark, root)
    assert again.version == 1 and again.keys == ["k"] and again.attrs == ["name"]
    again.apply(rows(spark, [("b", "y2", "2024-01-03 00:00:00"), ("a", "old", "2023-12-01 00:00:00")]),
                "2024-01-03 01:00:00")
    assert table(again.scd2(), "k", "name", "is_current") == [
        ("a", "x", False), ("a", "x2", True), ("b", "y", False), ("b", "y2", True)]
    assert again.log().count() == 4
    st.apply(rows(spark, [("b", "y2", "2024-01-03 00:00:00")]), "2024-01-03 01:00:00")
    cols = ["sk_name", "k", "name", "valid_from_sk", "valid_to", "is_current"]
    assert table(st.scd2(), *cols) == table(again.scd2(), *cols)


def test_composite_natural_key(spark):
    import datetime as dt
    import uuid

    ddl = "region string, code int, name string, t timestamp_ntz"
    d = dt.datetime.fromisoformat
    b0 = spark.createDataFrame([("n", 1, "a", d("2024-01-01 00:00:00")), ("s", 1, "b", d("2024-01-01 00:00:00")),
                                ("n", 2, "c", d("2024-01-01 00:00:00"))], ddl)
    b1 = spark.createDataFrame([("n", 1, "a2", d("2024-01-02 00:00:00")), ("s", 2, "new", d("2024-01-02 00:00:00"))], ddl)
    st = DimensionStore(spark, new_run_dir(spark, "ck"), ["region", "code"], "t", attrs=["name"])
    st.apply(b0, "2024-01-01 01:00:00")
    st.apply(b1, "2024-01-02 01:00:00")
    s2 = st.scd2()
    assert table(s2, "region", "code", "name", "is_current") == [
        ("n", 1, "a", False), ("n", 1, "a2", True), ("n", 2, "c", True), ("s", 1, "b", True), ("s", 2, "new", True)]
    ns = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")
    r = s2.where("region = 'n' AND code = 1 AND is_current").first()
    assert r.sk_name == str(uuid.uuid5(ns, "n|1|2024-01-02 00:00:00"))
    assert scd2_violations(s2, ["region", "code"]).count() == 0
    assert st.bronze().count() == 4 and st.scd1().count() == 4
    comp = {(x.region, x.code): x.scd2_total_versions for x in st.gold_comparison().collect()}
    assert comp == {("n", 1): 2, ("n", 2): 1, ("s", 1): 1, ("s", 2): 1}


def test_store_keeps_skipped_rows(spark):
    st = DimensionStore(spark, new_run_dir(spark, "skip"), ["k"], "t", audit_skipped=True)
    st.apply(rows(spark, [("a", "x", "2024-01-02 00:00:00")]), "2024-01-02 01:00:00")
    st.apply(rows(spark, [("b", "late", "2024-01-01 00:00:00"), ("c", "tie", "2024-01-02 00:00:00"),
                          ("a", "new", "2024-01-03 00:00:00")]), "2024-01-03 01:00:00")
    assert table(st.skipped(), "k", "name", "_commit_id") == [("b", "late", 1), ("c", "tie", 1)]
    assert table(st.bronze(), "k", "name") == [("a", "new")]


def test_scd1_ignore_policy_in_store(spark):
    st = DimensionStore(spark, new_run_dir(spark, "s1ign"), ["k"], "t", scd1_policy="ignore")
    st.apply(rows(spark, [("a", "x", "2024-01-01 00:00:00"), ("b", "y", "2024-01-01 00:00:00")]),
             "2024-01-01 01:00:00")
    sk = {r.k: r.sk_name for r in st.scd1().collect()}
    b1 = spark.createDataFrame([("a", "2024-02-01 00:00:00", "red")], "k string, t string, color string")
    st.apply(b1.withColumn("t", F.col("t").cast("timestamp_ntz")), "2024-02-01 01:00:00")
    s1 = {r.k: r for r in st.scd1().collect()}
    assert "color" not in st.scd1().columns and "color" in st.bronze().columns
    assert s1["a"].name is None and s1["b"].name == "y"
    assert s1["a"].sk_name == sk["a"] and s1["b"].sk_name == sk["b"]
