"""The two-batch cost-centre scenario with hand-derived expected values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronodim.operators.checks import check_not_null, duplicate_groups, scd2_violations
from chronodim.operators.reads import as_of_time
from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import new_run_dir

from conftest import T_UPDATE

EXPECTED_SCD2 = {
    ("47c1fe96-1136-5ced-a420-b099e50a717f", "cd001", "Centro Norte", "ACTIVE", "2024-01-15 10:00:00", None, True, "VIGENTE", None),
    ("3ff09d83-ffdf-5838-83b8-1d24e6fd3f75", "cd002", "Centro Sur", "ACTIVE", "2024-01-15 10:00:00", None, True, "VIGENTE", None),
    ("d57a0df6-b0b7-57c1-b318-40e7add11bb5", "cd003", "Centro Este", "ACTIVE", "2024-02-20 09:30:00", T_UPDATE, False, "HISTORICO", 466),
    ("1b7f504b-0b79-54f0-b3b2-3d15bdbec429", "cd003", "Centro Este 2.0", "ACTIVE", T_UPDATE, None, True, "VIGENTE", None),
    ("a0ba9f85-005a-5ddb-b76d-2749f4bb969a", "cd004", "Centro Oeste", "INACTIVE", "2024-03-10 14:00:00", T_UPDATE, False, "HISTORICO", 447),
    ("9c2f2009-b946-500a-9d45-714cbe306e23", "cd004", "Centro Oeste", "ACTIVE", T_UPDATE, None, True, "VIGENTE", None),
    ("bd7da79e-c7ce-5a35-b471-f842ac159fbd", "cd005", "Centro CDMX", "ACTIVE", "2024-03-10 14:00:00", None, True, "VIGENTE", None),
    ("aa918789-496a-5e69-9d38-84c8066bde66", "cd006", "Centro Bajio", "ACTIVE", T_UPDATE, None, True, "VIGENTE", None),
}


def _txt(v):
    return v.strftime("%Y-%m-%d %H:%M:%S") if isinstance(v, dt.datetime) else v


@pytest.fixture()
def store(spark, raw0, raw1):
    st = DimensionStore(spark, new_run_dir(spark, "golden"), ["center_cd"], "updated_at",
                        casts={"valid_from": "date"}, attrs=["center_name", "status"])
    st.apply(raw0, "2024-04-01 00:00:00")
    st._raw1 = raw1
    return st


def test_batch0(store):
    assert store.bronze().count() == 5 and store.scd1().count() == 5
    s2 = store.scd2()
    assert s2.count() == 5 and s2.where("is_current").count() == 5
    g = store.gold_comparison()
    assert g.where("has_history").count() == 0 and g.count() == 5
    assert store.gold_history().where("days_valid IS NOT NULL").count() == 0
    assert dict(store.bronze().dtypes)["valid_from"] == "date"


def test_batch1_golden(store):
    keys0 = {r.center_cd: r.sk_name for r in store.scd1().collect()}
    store.apply(store._raw1, "2025-06-02 00:00:00")
    assert store.bronze().count() == 6
    hist = store.gold_history().select("sk_name", "center_cd", "center_name", "status", "valid_from_sk",
                                       "valid_to", "is_current", "record_state", "days_valid").collect()
    assert {tuple(_txt(v) for v in r) for r in hist} == EXPECTED_SCD2
    # type 1: stable keys for known centres, a new one for cd006
    s1 = {r.center_cd: r for r in store.scd1().collect()}
    assert len(s1) == 6
    for k, sk in keys0.items():
        assert s1[k].sk_name == sk
    assert s1["cd006"].sk_name not in keys0.values() and s1["cd006"].sk_name[14] == "7"
    assert s1["cd003"].center_name == "Centro Este 2.0" and s1["cd004"].status == "ACTIVE"
    comp = {r.center_cd: (r.has_history, r.scd2_total_versions) for r in store.gold_comparison().collect()}
    assert comp == {"cd001": (False, 1), "cd002": (False, 1), "cd003": (True, 2), "cd004": (True, 2),
                    "cd005": (False, 1), "cd006": (False, 1)}
    # watermark of batch 1 and the three accepted rows
    log = store.log()
    assert log.where("_commit_id = 1").count() == 3
    # checks declared on the tables
    assert check_not_null(store.scd2(), ["sk_name", "center_cd", "is_current"]).count() == 0
    assert duplicate_groups(store.scd2(), ["sk_name"]).count() == 0
    assert duplicate_groups(store.scd1(), ["center_cd"]).count() == 0
    assert scd2_violations(store.scd2(), ["center_cd"]).count() == 0


def test_point_in_time_and_as_of_version(store):
    store.apply(store._raw1, "2025-06-02 00:00:00")
    s2 = store.scd2()
    cd4 = F.col("center_cd") == "cd004"
    r = as_of_time(s2, "2024-06-01 00:00:00", cd4).collect()
    assert [(x.sk_name, x.status) for x in r] == [("a0ba9f85-005a-5ddb-b76d-2749f4bb969a", "INACTIVE")]
    r = as_of_time(s2, T_UPDATE, cd4).collect()
    assert [(x.sk_name, x.status) for x in r] == [("9c2f2009-b946-500a-9d45-714cbe306e23", "ACTIVE")]
    assert as_of_time(s2, "2024-03-10 13:59:59", cd4).count() == 0
    assert store.bronze_as_of(0).where(cd4).first().status == "INACTIVE"
    assert store.bronze_as_of(1).where(cd4).first().status == "ACTIVE"
    commits = store.commits().collect()
    assert [(c.snapshot_id, c.operation, c.summary["added-records"]) for c in commits] == \
        [(0, "append", "5"), (1, "overwrite", "3")]
    # type 2 as of the first commit is the pre-update table
    assert store.scd2(0).count() == 5 and store.scd2(0).where("is_current").count() == 5


def test_rerun_is_noop(store):
    store.apply(store._raw1, "2025-06-02 00:00:00")
    before = {tuple(r) for r in store.scd2().drop("_silver_created_at").collect()}
    store.apply(store._raw1, "2025-06-03 00:00:00")
    assert store.log().where("_commit_id = 2").count() == 0
    assert {tuple(r) for r in store.scd2().drop("_silver_created_at").collect()} == before
    assert store.bronze().count() == 6 and store.scd1().count() == 6


def test_sql_reports_over_views(spark, store):
    store.apply(store._raw1, "2025-06-02 00:00:00")
    store.register_views()
    r = spark.sql("""
        SELECT sk_name, center_cd, center_name, status, valid_from_sk, valid_to
        FROM silver_scd2
        WHERE center_cd = 'cd004'
          AND valid_from_sk <= TIMESTAMP'2024-06-01 00:00:00'
          AND (valid_to IS NULL OR valid_to > TIMESTAMP'2024-06-01 00:00:00')""").collect()
    assert [x.sk_name for x in r] == ["a0ba9f85-005a-5ddb-b76d-2749f4bb969a"]
    cur = spark.sql("SELECT center_cd FROM silver_scd2 WHERE is_current = true ORDER BY center_cd").collect()
    assert [x.center_cd for x in cur] == ["cd001", "cd002", "cd003", "cd004", "cd005", "cd006"]
    snaps = spark.sql("SELECT snapshot_id, operation FROM snapshots ORDER BY committed_at").collect()
    assert [(s.snapshot_id, s.operation) for s in snaps] == [(0, "append"), (1, "overwrite")]
    g = spark.sql("SELECT center_cd, has_history FROM gold_comparison WHERE has_history ORDER BY center_cd")
    assert [x.center_cd for x in g.collect()] == ["cd003", "cd004"]


def test_stored_watermark_equals_bronze_max(store):
    from chronodim.operators.watermark import high_watermark

    store.apply(store._raw1, "2025-06-02 00:00:00")
    for v in (0, 1):
        assert store.watermark(v).first().watermark == high_watermark(store.bronze(v)).first().watermark


def test_refreshed_comparison_equals_full_rebuild(spark, store):
    from chronodim.operators.gold import compare_dimensions

    store.apply(store._raw1, "2025-06-02 00:00:00")
    full = compare_dimensions(store.scd1(), store.scd2(), ["center_cd"], ["center_name", "status"])
    cols = [c for c in full.columns if c != "_gold_created_at"]
    assert sorted(store.gold_comparison().select(cols).collect()) == sorted(full.select(cols).collect())


def test_bronze_rebuilt_from_log(store):
    from chronodim.operators.changelog import table_from_log

    store.apply(store._raw1, "2025-06-02 00:00:00")
    cols = [c for c in store.bronze().columns if c != "_ingested_at"]
    assert sorted(table_from_log(store.log(), ["center_cd"]).select(cols).collect()) == \
        sorted(store.bronze().select(cols).collect())
