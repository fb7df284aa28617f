"""Registered queries over the test tables, one per operator of the build.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame.  Queries over
a change feed share one persisted build of that feed (four runs through
every layer), kept per Spark application and data folder.  Audit times and
random type-1 keys are left out of compared outputs; every computed column
is aliased to the name the SQL oracle uses (see ``oracle.py``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronodim.constants import (
    AUDIT_COLUMNS,
    COMMIT_ID,
    IS_CURRENT,
    SK,
    SOURCE_TS,
    VALID_FROM,
    VALID_TO,
)
from chronodim.functions.keys import register_sql_functions, uuid5, uuid7
from chronodim.operators.checks import file_overlaps, key_idempotence, null_counts, scd2_interval_report, uniqueness_summary
from chronodim.operators.gold import version_counts
from chronodim.operators.ingest import accepted_changes, bronze_ingest, to_bronze_rows
from chronodim.operators.maintenance import cluster_by_range, overwrite_via_staging, patch_rows
from chronodim.operators.merge import upsert
from chronodim.operators.reads import (
    comparison_report,
    scd1_report,
    scd2_current_report,
    scd2_versions_report,
)
from chronodim.operators.scd import scd2_close, scd2_initial, scd2_new_versions
from chronodim.operators.schema import evolve
from chronodim.operators.watermark import above_watermark, high_watermark, late_rows
from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import apply_session_defaults, new_run_dir, write_table
from chronodim.sources.feeds import EVENTS, ORDERS, FeedSpec, feed_batch, read_feed, read_table
from chronodim.sources.seed import land_seed, write_csv_seed

Query = Callable[[SparkSession, str], DataFrame]

# Instant of the point-in-time reads and the key of the single-key read.
PIT_TIME = "2024-01-20 00:00:00"
PIT_KEY = 7
# The events feed with a tie-break, for versions of every change.
EVERY = replace(EVENTS, name="events_every", tiebreak=("event_id",))
# Fixed run time stamped into uuid v7 keys by the key-property query.
UUID7_RUN_TS = "2024-01-01 00:00:00"
CUSTOMER_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"

# expressions of the columns ``number`` and ``day`` in each batch of a source
# whose types widen
WIDENING = (("cast(event_id AS int)", "cast(ts AS date)"), ("event_id + 3000000000", "cast(ts AS date)"),
            ("cast(event_id + 0.25BD AS decimal(22, 2))", "ts"), ("cast(event_id % 1000 AS smallint)", "cast(ts AS date)"))

_BUILDS: dict[tuple, DimensionStore] = {}


def reset_builds() -> None:
    """Forget persisted feed builds (the next query rebuilds)."""
    _BUILDS.clear()


def build(spark: SparkSession, sf_dir: str, spec: FeedSpec, kind: str = "plain") -> DimensionStore:
    """All batches of ``spec`` run through every layer, persisted once.
    ``deferred``: marts built after the first and after the last run only;
    ``narrowing``: the column ``props`` is gone from the third batch on;
    ``widening``: column types widen from run to run (see ``WIDENING``);
    ``every``: a version for every change, not only a run's latest one of a key."""
    apply_session_defaults(spark)
    key = (spark.sparkContext.applicationId, sf_dir, spec.name, kind, _state_of(spark, f"{sf_dir}/{spec.table}.parquet"))
    if key not in _BUILDS:
        feed = read_feed(spark, sf_dir, spec)
        store = DimensionStore(spark, new_run_dir(spark, f"{spec.name}-{kind}"), spec.keys, spec.ts,
                               tiebreak=spec.tiebreak, attrs=("event_type", "number", "day") if kind == "widening" else spec.attrs, key_ranges=4 if kind in ("deferred", "widening", "every") else None,
                               on_duplicate="all" if kind == "every" else "latest")
        for n in range(spec.n_batches):
            batch = feed_batch(feed, n, spec)
            if kind == "narrowing" and n > 1:
                batch = batch.drop("props")
            if kind == "widening":
                number, day = WIDENING[n]
                batch = batch.select(*spec.keys, spec.ts, F.expr(number).alias("number"), F.expr(day).alias("day"), F.col("event_type"))
            store.apply(batch, spec.run_times[n], build_gold=kind != "deferred" or n == 0)
            if kind == "plain" and spec is EVENTS:  # a copy of the keys after each run
                store.scd1().select(*spec.keys, SK).write.parquet(f"{store.root}/key_copies/{COMMIT_ID}={n}")
        if kind == "deferred":
            store.build_gold(spec.run_times[-1])
        _BUILDS[key] = store
    return _BUILDS[key]


def _state_of(spark: SparkSession, path: str) -> tuple:
    """Length and change time of the files of a table, so that a build is
    kept only while its input stays the same."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p))


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)


# ------------------------------------------------------------------ ingest
def _union(parts):
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def _batch_no(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("batch", F.lit(n).cast("long"))


def q_bronze_ingest(spark, sf):
    """Bronze after each batch, each state made from the one before."""
    feed, state, states = read_feed(spark, sf, EVENTS), None, []
    for n in range(EVENTS.n_batches):
        state = write_table(bronze_ingest(feed_batch(feed, n, EVENTS), state, EVENTS.keys, EVENTS.ts, run_ts=EVENTS.run_times[n]),
                            new_run_dir(spark, f"bronze-{n}"))
        states.append(_batch_no(_no_audit(state), n))
    return _union(states)


def q_seed_load(spark, sf):
    """Customers through a CSV seed landed as parquet."""
    path = new_run_dir(spark, "seed")
    write_csv_seed(read_table(spark, sf, "customer"), f"{path}/customer_csv")
    return land_seed(spark, f"{path}/customer_csv", f"{path}/customer", CUSTOMER_DDL)


def q_seed_text(spark, sf):
    """Documents (quotes, line breaks and all) through a CSV seed."""
    path = new_run_dir(spark, "seed-text")
    docs = read_table(spark, sf, "documents")
    write_csv_seed(docs, f"{path}/csv")
    return land_seed(spark, f"{path}/csv", f"{path}/documents", "doc_id bigint, text string, lang string, source string, n_chars bigint")


def q_typed_ingest(spark, sf):
    """Events through a CSV seed whose dates and times are text, cast to date
    and timestamp on the way into bronze."""
    path = new_run_dir(spark, "seed-typed")
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("ts").cast("string").alias("ts"))
    write_csv_seed(ev, f"{path}/csv")
    raw = land_seed(spark, f"{path}/csv", f"{path}/events", "event_id bigint, user_id bigint, event_type string, day string, ts string")
    out = to_bronze_rows(raw, "ts", casts={"day": "date"})
    return _no_audit(out).withColumn(SOURCE_TS, F.col(SOURCE_TS).cast("timestamp_ntz"))


def q_high_watermark(spark, sf):
    st = build(spark, sf, EVENTS)
    parts = [high_watermark(st.bronze(v)).select(F.lit(v).cast("long").alias("commit_id"), "watermark")
             for v in range(st.version + 1)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_watermark_filter(spark, sf):
    st = build(spark, sf, ORDERS)
    feed = read_feed(spark, sf, ORDERS)
    return _union(_batch_no(above_watermark(feed_batch(feed, n, ORDERS), st.bronze(n - 1), ts=ORDERS.ts, state_ts=SOURCE_TS), n)
                  for n in range(1, st.version + 1))


def q_late_rows(spark, sf):
    st = build(spark, sf, ORDERS)
    feed = read_feed(spark, sf, ORDERS)
    out = None
    for n in range(1, st.version + 1):
        part = late_rows(feed_batch(feed, n, ORDERS), st.bronze(n - 1), ts=ORDERS.ts, state_ts=SOURCE_TS) \
            .withColumn("batch", F.lit(n).cast("long"))
        out = part if out is None else out.unionByName(part)
    return out


def q_merge_upsert(spark, sf):
    return _no_audit(build(spark, sf, EVENTS).bronze())


def q_report_bronze(spark, sf):
    b = build(spark, sf, EVENTS).bronze()
    return b.select(*EVENTS.keys, *EVENTS.attrs, SOURCE_TS).orderBy(*EVENTS.keys)


def q_audit_columns(spark, sf):
    """The audit columns of every table under the fixed load times of the runs:
    rows by table, key and time, in zone-free form."""
    st = build(spark, sf, EVENTS)
    tables = {"bronze": (st.bronze(), "_ingested_at"), "scd1": (st.scd1(), "_silver_updated_at"), "scd2": (st.scd2(), "_silver_created_at"),
              "comparison": (st.gold_comparison(), "_gold_created_at"), "history": (st.gold_history(ordered=False), "_silver_created_at")}
    return _union(df.groupBy(*EVENTS.keys, F.col(c).cast("timestamp_ntz").alias("audit_time")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(t).alias("table_name"), "*") for t, (df, c) in tables.items())


def q_audit_clock(spark, sf):
    """The default audit time, where no load time is given: one instant for
    all rows, between the clock before and after the query was planned."""
    raw = read_table(spark, sf, "events")
    before = F.lit(dt.datetime.now(dt.timezone.utc).isoformat(sep=" ")).cast("timestamp")
    rows = to_bronze_rows(raw, "ts").agg(F.count(F.lit(1)).alias("n_rows"), F.min("_ingested_at").alias("lo"), F.max("_ingested_at").alias("hi"))
    return rows.select("n_rows", (F.col("lo") == F.col("hi")).alias("one_instant"), (F.col("lo") >= before).alias("after_start"),
                       (F.col("hi") <= F.current_timestamp()).alias("before_end"))


# ------------------------------------------------------------------ type 1
def q_scd1_current(spark, sf):
    return _no_audit(build(spark, sf, EVENTS).scd1()).drop(SK)


def q_report_scd1(spark, sf):
    r = scd1_report(build(spark, sf, EVENTS).scd1(), EVENTS.keys, EVENTS.attrs)
    return r.drop("sk_name_scd1", "_silver_updated_at")


def q_scd1_key_stability(spark, sf):
    """Type-1 keys over copies of the table made after each run."""
    snaps = spark.read.parquet(f"{build(spark, sf, EVENTS).root}/key_copies")
    return snaps.groupBy(*EVENTS.keys).agg(
        F.count_distinct(SK).alias("distinct_keys"),
        F.count(F.lit(1)).alias("snapshots"),
        F.min(F.substring(SK, 15, 1)).alias("version_digit"),
        F.bool_and(F.substring(SK, 20, 1).isin("8", "9", "a", "b") & (F.length(SK) == 36)).alias("variant_ok"),
    )


# ------------------------------------------------------------------ type 2
def q_scd2_initial(spark, sf):
    """A first load of the whole feed: one open version per key."""
    rows = to_bronze_rows(read_table(spark, sf, EVENTS.table), EVENTS.ts, run_ts=EVENTS.run_times[-1])
    return _no_audit(scd2_initial(rows, EVENTS.keys, run_ts=EVENTS.run_times[-1]))


def _delta(st: DimensionStore, v: int) -> DataFrame:
    return st.log().where(F.col(COMMIT_ID) == v).drop(COMMIT_ID, "_committed_at", "_operation")


def q_scd2_close(spark, sf):
    """Every version before each run, closed by that run's changes."""
    st = build(spark, sf, EVENTS)
    return _union(_batch_no(_no_audit(scd2_close(st.scd2(v - 1), _delta(st, v), EVENTS.keys)), v) for v in range(1, st.version + 1))


def q_scd2_new_versions(spark, sf):
    """The versions that each run appends after closing."""
    st = build(spark, sf, EVENTS)
    out = []
    for v in range(1, st.version + 1):
        closed = scd2_close(st.scd2(v - 1), _delta(st, v), EVENTS.keys)
        out.append(_batch_no(_no_audit(scd2_new_versions(_delta(st, v), closed, EVENTS.keys, run_ts=EVENTS.run_times[v])), v))
    return _union(out)


def q_scd2_late(spark, sf):
    return _no_audit(build(spark, sf, ORDERS).scd2())


def q_scd2_history(spark, sf):
    return _no_audit(build(spark, sf, EVENTS).scd2())


def q_report_scd2_versions(spark, sf):
    return scd2_versions_report(build(spark, sf, EVENTS).scd2(), EVENTS.keys, EVENTS.attrs)


def q_scd2_every_change(spark, sf):
    """Type 2 with a version for every change of a key, however many a run
    brings: each is closed by the next."""
    return _no_audit(build(spark, sf, EVERY, "every").scd2())


def q_scd2_current(spark, sf):
    return scd2_current_report(build(spark, sf, EVENTS).scd2(), EVENTS.keys, EVENTS.attrs)


def q_version_counts(spark, sf):
    return version_counts(build(spark, sf, EVENTS).scd2(), EVENTS.keys)


def q_scd2_invariants(spark, sf):
    return scd2_interval_report(build(spark, sf, EVENTS).scd2(), EVENTS.keys)


# ------------------------------------------------------------------ gold
def q_gold_comparison(spark, sf):
    return _no_audit(build(spark, sf, EVENTS).gold_comparison()).drop("sk1_uuid")


def q_report_comparison(spark, sf):
    return comparison_report(build(spark, sf, EVENTS).gold_comparison(), EVENTS.keys, "event_type").drop("sk1_uuid")


def q_gold_comparison_deferred(spark, sf):
    """The mart after three runs without mart builds, then one refresh."""
    return _no_audit(build(spark, sf, EVENTS, "deferred").gold_comparison()).drop("sk1_uuid")


def q_history_order(spark, sf):
    """Rows of the history mart as read: how many lie before their
    predecessor in key, start order, within and across partitions."""
    h = build(spark, sf, EVENTS).gold_history().select(F.struct(*EVENTS.keys, VALID_FROM).alias("k"), F.spark_partition_id().alias("p"),
                                                       F.monotonically_increasing_id().alias("at"))
    inside = h.withColumn("before", F.lag("k").over(W.partitionBy("p").orderBy("at")))
    parts = inside.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k") < F.col("before")).alias("bad"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    # one row a partition
    return parts.withColumn("hi_before", F.max("hi").over(W.orderBy("p").rowsBetween(W.unboundedPreceding, -1))) \
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), (F.coalesce(F.sum("bad"), F.lit(0)) + F.count_if(F.col("lo") < F.col("hi_before"))).alias("out_of_order"))


def q_gold_history(spark, sf):
    return _no_audit(build(spark, sf, EVENTS).gold_history())


# ------------------------------------------------------------------ reads
def q_point_in_time(spark, sf):
    v = build(spark, sf, EVENTS).as_of_time(PIT_TIME)
    return v.select(SK, *EVENTS.keys, *EVENTS.attrs, VALID_FROM, VALID_TO)


def q_point_in_time_key(spark, sf):
    v = build(spark, sf, EVENTS).as_of_time(PIT_TIME, F.col("user_id") == F.lit(PIT_KEY))
    return v.select(SK, *EVENTS.keys, *EVENTS.attrs, VALID_FROM, VALID_TO)


def q_commit_log(spark, sf):
    c = build(spark, sf, EVENTS).commits()
    return c.select(
        "snapshot_id", F.col("committed_at").cast("timestamp_ntz").alias("committed_at"), "operation",
        F.col("summary")["added-records"].cast("long").alias("added_records"),
        F.col("summary")["min-change-ts"].alias("min_change_ts"),
        F.col("summary")["max-change-ts"].alias("max_change_ts"),
    )


def q_as_of_version(spark, sf):
    return _no_audit(build(spark, sf, EVENTS).bronze(1))


def q_as_of_schema(spark, sf):
    """Commit 1 of a table from which a later run dropped a column: read
    back with the column."""
    return _no_audit(build(spark, sf, EVENTS, "narrowing").bronze(1))


# ------------------------------------------------------------------ maintenance
def q_raw_patch(spark, sf):
    """The customer table patched in place: the plan reads the table that it
    replaces, through a staged copy."""
    base = new_run_dir(spark, "patch")
    cust = write_table(read_table(spark, sf, "customer"), f"{base}/customer")
    new_row = cust.agg((F.max("c_custkey") + 1).alias("c_custkey")).select(
        "c_custkey", F.lit("Customer#new").alias("c_name"), F.lit(0).alias("c_nationkey"),
        F.lit(0.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"))
    patches = {3: {"c_name": "Customer#000000003 2.0"}, 4: {"c_mktsegment": "AUTOMOBILE", "c_acctbal": 0.0}}
    return overwrite_via_staging(patch_rows(cust, "c_custkey", patches, new_row), f"{base}/customer", f"{base}/customer_staging")


def q_range_clustered(spark, sf):
    """Rows of each clustered table, and how many of its files overlap
    another file's key range."""
    path = new_run_dir(spark, "clustered")
    orders = write_table(cluster_by_range(read_table(spark, sf, "orders"), ["o_orderkey"]), path)
    st = build(spark, sf, EVENTS, "deferred")
    return _union(file_overlaps(df, keys).select(F.lit(name).alias("table_name"), "*") for name, df, keys in (
        ("orders", orders, ["o_orderkey"]), ("scd1", st.scd1(), EVENTS.keys), ("scd2_current", st.scd2_current(), EVENTS.keys)))


def q_schema_sync(spark, sf):
    return _schema_case(spark, sf, "sync_all_columns")


def q_schema_ignore(spark, sf):
    return _schema_case(spark, sf, "ignore")


def q_schema_widen(spark, sf):
    """Every table of a build whose source widens its types from run to run."""
    st = build(spark, sf, EVENTS, "widening")
    shown = [*EVENTS.keys, F.col("number").cast("string").alias("number"), F.col("day").cast("string").alias("day"), "event_type", SOURCE_TS,
             F.typeof("number").alias("number_type"), F.typeof("day").alias("day_type")]
    return _union(df.select(F.lit(name).alias("table_name"), *shown) for name, df in (("bronze", st.bronze()), ("scd1", st.scd1()), ("scd2", st.scd2())))


def _schema_case(spark, sf, policy):
    """The first batch arrives without ``props``; all later ones have it and
    lack ``value``.  The upserted table follows ``policy``."""
    feed, path = read_feed(spark, sf, EVENTS), new_run_dir(spark, f"schema-{policy}")
    state = write_table(bronze_ingest(feed_batch(feed, 0, EVENTS).drop("props"), None, EVENTS.keys, EVENTS.ts, run_ts=EVENTS.run_times[0]), f"{path}/0")
    for n in range(1, EVENTS.n_batches):
        chg = accepted_changes(feed_batch(feed, n, EVENTS).drop("value"), state, EVENTS.keys, EVENTS.ts, run_ts=EVENTS.run_times[n])
        chg = write_table(chg, f"{path}/changes-{n}")
        state = write_table(upsert(*evolve(state, chg, policy), EVENTS.keys), f"{path}/{n}")
    return _no_audit(state)


# ------------------------------------------------------------------ keys and checks
def _customer_seed() -> F.Column:
    return F.concat(F.col("c_custkey").cast("string"), F.lit("|"), F.col("c_name"))


def q_uuid5_key(spark, sf):
    cust = read_table(spark, sf, "customer").select("c_custkey", _customer_seed().alias("seed"))
    edge = spark.sql("SELECT * FROM VALUES (-1L, CAST(NULL AS STRING)), (-2L, ''), (-3L, 'ñandú|日本') "
                     "AS edge(c_custkey, seed)")
    both = cust.unionByName(edge)
    return both.select("c_custkey", "seed", uuid5(F.col("seed")).alias(SK))


def q_sql_uuid5(spark, sf):
    register_sql_functions(spark)
    cust = read_table(spark, sf, "customer")
    return spark.sql(
        "SELECT c_custkey, uuid5_sk(concat(cast(c_custkey AS string), '|', c_name)) AS sk_name FROM {c}", c=cust)


def q_key_idempotence(spark, sf):
    """Type-2 keys stored by the incremental runs against those of a full
    refresh of the same batches."""
    stored = build(spark, sf, EVENTS)
    again = DimensionStore(spark, new_run_dir(spark, "refresh"), EVENTS.keys, EVENTS.ts, attrs=EVENTS.attrs)
    feed = read_feed(spark, sf, EVENTS)
    again.apply(feed_batch(feed, EVENTS.n_batches - 1, EVENTS), EVENTS.run_times[-1], build_gold=False)  # a state to be refreshed away
    for n in range(EVENTS.n_batches):
        again.apply(feed_batch(feed, n, EVENTS), EVENTS.run_times[n], build_gold=False, refresh=n == 0)
    return key_idempotence(stored.scd2(), again.scd2(), EVENTS.keys)


def q_uuid7_properties(spark, sf):
    run = dt.datetime.fromisoformat(UUID7_RUN_TS).replace(tzinfo=dt.timezone.utc)
    ms_hex = f"{int(run.timestamp() * 1000):012x}"
    prefix = f"{ms_hex[:8]}-{ms_hex[8:]}"
    run_instant = F.timestamp_millis(F.lit(int(run.timestamp() * 1000)))  # zone-independent
    k = read_table(spark, sf, "orders").repartition(8).select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at"), uuid7(run_instant).alias("k"))
    k = k.withColumn("before", F.lag("k").over(W.partitionBy("p").orderBy("at")))
    return k.agg(
        F.count_if(F.col("k") <= F.col("before")).alias("n_not_ascending"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("k").alias("n_distinct"),
        F.count_if(F.substring("k", 15, 1) == "7").alias("n_version7"),
        F.count_if(F.substring("k", 20, 1).isin("8", "9", "a", "b")).alias("n_variant_ok"),
        F.count_if(F.length("k") == 36).alias("n_len36"),
        F.count_if(F.substring("k", 1, 13) == F.lit(prefix)).alias("n_time_prefix"),
    )


def _dimension_tables(st: DimensionStore) -> dict[str, DataFrame]:
    return {"bronze": st.bronze(), "scd1": st.scd1(), "scd2": st.scd2(), "comparison": st.gold_comparison(), "history": st.gold_history(ordered=False)}


KEY = EVENTS.keys[0]
# declared column tests of the dimension tables
NOT_NULL_CHECKS = {"bronze": [KEY], "scd1": [SK, KEY], "scd2": [SK, KEY, IS_CURRENT], "comparison": [KEY], "history": [SK, KEY]}
UNIQUE_CHECKS = {"orders": ["o_orderkey", "o_custkey"], "documents": ["doc_id", "text"], "bronze": [KEY], "scd1": [SK, KEY], "scd2": [SK],
                 "comparison": [KEY], "history": [SK]}


def q_check_not_null(spark, sf):
    dims = _dimension_tables(build(spark, sf, EVENTS))
    parts = [null_counts(read_table(spark, sf, t)).select(F.lit(t).alias("table_name"), "*") for t in ("orders", "documents")]
    return _union(parts + [null_counts(dims[t], cols).select(F.lit(t).alias("table_name"), "*") for t, cols in NOT_NULL_CHECKS.items()])


def q_check_unique(spark, sf):
    dims = _dimension_tables(build(spark, sf, EVENTS))
    return _union(uniqueness_summary(dims[t] if t in dims else read_table(spark, sf, t), [c]).select(
        F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "*") for t, cols in UNIQUE_CHECKS.items() for c in cols)


def _pinned(q: Query) -> Query:
    """Run ``q`` under the session settings results depend on (UTC)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_session_defaults(spark)
        return q(spark, sf_dir)
    run.__name__ = q.__name__
    run.__doc__ = q.__doc__
    return run


QUERIES: dict[str, Query] = {
    "bronze_ingest": q_bronze_ingest,
    "seed_load": q_seed_load,
    "seed_text": q_seed_text,
    "typed_ingest": q_typed_ingest,
    "high_watermark": q_high_watermark,
    "watermark_filter": q_watermark_filter,
    "late_rows": q_late_rows,
    "merge_upsert": q_merge_upsert,
    "report_bronze": q_report_bronze,
    "audit_columns": q_audit_columns,
    "audit_clock": q_audit_clock,
    "scd1_current": q_scd1_current,
    "report_scd1": q_report_scd1,
    "scd1_key_stability": q_scd1_key_stability,
    "scd2_initial": q_scd2_initial,
    "scd2_close": q_scd2_close,
    "scd2_new_versions": q_scd2_new_versions,
    "scd2_late": q_scd2_late,
    "scd2_history": q_scd2_history,
    "report_scd2_versions": q_report_scd2_versions,
    "scd2_every_change": q_scd2_every_change,
    "scd2_current": q_scd2_current,
    "version_counts": q_version_counts,
    "scd2_invariants": q_scd2_invariants,
    "gold_comparison": q_gold_comparison,
    "gold_comparison_deferred": q_gold_comparison_deferred,
    "report_comparison": q_report_comparison,
    "gold_history": q_gold_history,
    "history_order": q_history_order,
    "point_in_time": q_point_in_time,
    "point_in_time_key": q_point_in_time_key,
    "commit_log": q_commit_log,
    "as_of_version": q_as_of_version,
    "as_of_schema": q_as_of_schema,
    "raw_patch": q_raw_patch,
    "range_clustered": q_range_clustered,
    "schema_sync": q_schema_sync,
    "schema_ignore": q_schema_ignore,
    "schema_widen": q_schema_widen,
    "uuid5_key": q_uuid5_key,
    "sql_uuid5": q_sql_uuid5,
    "key_idempotence": q_key_idempotence,
    "uuid7_properties": q_uuid7_properties,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
}
QUERIES = {k: _pinned(v) for k, v in QUERIES.items()}
