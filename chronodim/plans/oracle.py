"""DuckDB SQL for every registered query, computed a different way.

Where the Spark side folds batches run by run, the SQL side states the end
result directly: a row of batch ``n`` is accepted when its time is above
the maximum of all rows of earlier batches; the latest accepted row per key
and batch is a version; a version ends where the next one of its key
starts (``lead``).  Tables ``events``, ``orders``, ``customer``,
``documents`` are views over the same parquet files.
"""

from __future__ import annotations

from chronodim.constants import (
    DEFAULT_SOURCE_SYSTEM,
    SCD1_BEHAVIOR,
    SCD2_BEHAVIOR,
    STATE_CLOSED,
    STATE_OPEN,
    UUID5_NAMESPACE,
)
from chronodim.sources.feeds import EVENTS, ORDERS, FeedSpec

NS_HEX = UUID5_NAMESPACE.replace("-", "")
SAP = f"'{DEFAULT_SOURCE_SYSTEM}'"


def duck_uuid5(seed_sql: str) -> str:
    """uuid v5 text of a SQL seed expression, DuckDB dialect."""
    h = f"sha1(unhex('{NS_HEX}') || encode(coalesce({seed_sql}, '')))"
    nib = f"((strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) & 3) + 1"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"substr('89ab', {nib}, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))")


def _batch_sql(spec: FeedSpec) -> str:
    whens = " ".join(f"WHEN {spec.ts} < TIMESTAMP '{b}' THEN {i}" for i, b in enumerate(spec.bounds))
    period = f"CASE {whens} ELSE {len(spec.bounds)} END"
    if not spec.late_every:
        return period
    late = f"CASE WHEN {spec.tiebreak[0]} % {spec.late_every} = 0 THEN 1 ELSE 0 END"
    return f"least({spec.n_batches - 1}, {period} + {late})"


def _ctes(spec: FeedSpec) -> str:
    """``f`` feed rows with batch ``b``; ``acc`` accepted rows; ``dd`` latest
    accepted row per key and batch; ``vw`` versions with next start ``nxt``."""
    key = ", ".join(spec.keys)
    order = ", ".join([f"{spec.ts} DESC"] + [f"{t} DESC" for t in spec.tiebreak])
    return f"""
f AS (SELECT *, {_batch_sql(spec)} AS b FROM {spec.table}),
bm AS (SELECT b, max({spec.ts}) AS m FROM f GROUP BY b),
wm AS (SELECT x.b, (SELECT max(y.m) FROM bm y WHERE y.b < x.b) AS w FROM bm x),
acc AS (SELECT f.* FROM f JOIN wm USING (b) WHERE wm.w IS NULL OR f.{spec.ts} > wm.w),
dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key}, b ORDER BY {order}) AS rn
       FROM acc) WHERE rn = 1),
vw AS (SELECT *, lead({spec.ts}) OVER (PARTITION BY {key} ORDER BY {spec.ts}) AS nxt FROM dd)"""


def _with(spec: FeedSpec, *extra: str) -> str:
    parts = [_ctes(spec)] + list(extra)
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


# column lists of the feed tables in bronze order (raw order, change time last)
def _biz(spec: FeedSpec) -> list[str]:
    cols = {EVENTS.name: ["event_id", "ts", "user_id", "event_type", "value", "props"],
            ORDERS.name: ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                          "o_orderpriority"]}[spec.name]
    return [c for c in cols if c != spec.ts]


def _bronze_cols(spec: FeedSpec, src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join([p + c for c in _biz(spec)] + [f"{p}{spec.ts} AS source_updated_at", f"{SAP} AS _source_system"])


def _seed(spec: FeedSpec, src: str = "") -> str:
    p = f"{src}." if src else ""
    keys = " || '|' || ".join(f"CAST({p}{k} AS VARCHAR)" for k in spec.keys)
    return f"{keys} || '|' || CAST({p}{spec.ts} AS VARCHAR)"


def _version_cols(spec: FeedSpec, valid_to: str = "nxt", src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join([
        f"{duck_uuid5(_seed(spec, src))} AS sk_name",
        *[p + c for c in _biz(spec)],
        f"{p}{spec.ts} AS source_updated_at",
        f"{p}{spec.ts} AS valid_from_sk",
        f"{valid_to} AS valid_to",
        f"({valid_to}) IS NULL AS is_current",
        f"{SAP} AS _source_system",
    ])


E = EVENTS
O = ORDERS
E_KEY = E.keys[0]


def _events_bronze_latest(upto_batch: int | None = None) -> str:
    where = "" if upto_batch is None else f"WHERE b <= {upto_batch}"
    return (_with(E) + f"SELECT {_bronze_cols(E)} FROM (SELECT *, row_number() OVER (PARTITION BY {E_KEY} "
            f"ORDER BY b DESC) AS r FROM dd {where}) WHERE r = 1")


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["bronze_ingest"] = "\nUNION ALL\n".join(
    f"SELECT *, CAST({n} AS BIGINT) AS batch FROM ({_events_bronze_latest(n)})" for n in range(E.n_batches))

ORACLE_SQL["seed_load"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

ORACLE_SQL["seed_text"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"

ORACLE_SQL["typed_ingest"] = f"""SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
  ts AS source_updated_at, {SAP} AS _source_system FROM events"""

ORACLE_SQL["high_watermark"] = _with(E) + """SELECT CAST(x.b AS BIGINT) AS commit_id,
  (SELECT max(ts) FROM acc a WHERE a.b <= x.b) AS watermark FROM bm x"""

ORACLE_SQL["watermark_filter"] = _with(O) + """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  o_orderdate, o_orderpriority, CAST(f.b AS BIGINT) AS batch FROM f JOIN wm USING (b) WHERE f.b > 0 AND o_orderdate > wm.w"""

ORACLE_SQL["late_rows"] = _with(O) + """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority, CAST(f.b AS BIGINT) AS batch FROM f JOIN wm USING (b)
  WHERE f.b > 0 AND (o_orderdate IS NULL OR o_orderdate <= wm.w)"""

ORACLE_SQL["merge_upsert"] = _events_bronze_latest()

ORACLE_SQL["report_bronze"] = _with(E) + "SELECT user_id, event_type, value, ts AS source_updated_at FROM vw WHERE nxt IS NULL"

_RUN = "CASE b " + " ".join(f"WHEN {i} THEN TIMESTAMP '{t}'" for i, t in enumerate(E.run_times)) + " END"
_LAST_RUN = f"TIMESTAMP '{E.run_times[-1]}'"
# bronze and type 1 carry the time of the run that wrote a key last, type 2 and
# the history mart that of the run that opened a version; the comparison mart is
# written for the key ranges of the last run
ORACLE_SQL["audit_columns"] = _with(E) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, {E_KEY}, {when} AS audit_time, count(*) AS n_rows FROM vw WHERE {which} GROUP BY ALL"
    for t, when, which in (("bronze", _RUN, "nxt IS NULL"), ("scd1", _RUN, "nxt IS NULL"), ("scd2", _RUN, "true"), ("comparison", _LAST_RUN, "nxt IS NULL"), ("history", _RUN, "true")))

ORACLE_SQL["audit_clock"] = "SELECT count(*) AS n_rows, true AS one_instant, true AS after_start, true AS before_end FROM events"

ORACLE_SQL["scd1_current"] = _events_bronze_latest()

ORACLE_SQL["report_scd1"] = _with(E) + "SELECT user_id, event_type, value FROM vw WHERE nxt IS NULL"

ORACLE_SQL["scd1_key_stability"] = _with(E) + f"""SELECT {E_KEY}, CAST(1 AS BIGINT) AS distinct_keys,
  CAST({E.n_batches} - min(b) AS BIGINT) AS snapshots, '7' AS version_digit, true AS variant_ok
  FROM dd GROUP BY {E_KEY}"""

ORACLE_SQL["scd2_initial"] = f"""SELECT {_version_cols(E, 'CAST(NULL AS TIMESTAMP)')} FROM (
  SELECT *, row_number() OVER (PARTITION BY {E_KEY} ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1"""

ORACLE_SQL["scd2_close"] = _with(E) + "\nUNION ALL\n".join(
    f"""SELECT {_version_cols(E, 'vt')}, CAST({n} AS BIGINT) AS batch FROM (
  SELECT *, lead(ts) OVER (PARTITION BY {E_KEY} ORDER BY ts) AS vt FROM dd WHERE b <= {n}) WHERE b < {n}""" for n in range(1, E.n_batches))

ORACLE_SQL["scd2_new_versions"] = _with(E) + f"""SELECT {_version_cols(E, 'CAST(NULL AS TIMESTAMP)')},
  CAST(b AS BIGINT) AS batch FROM dd WHERE b > 0"""

ORACLE_SQL["scd2_late"] = _with(O) + f"SELECT {_version_cols(O)} FROM vw"

ORACLE_SQL["scd2_history"] = _with(E) + f"SELECT {_version_cols(E)} FROM vw"

ORACLE_SQL["scd2_every_change"] = _with(E) + f""", one AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY {E_KEY}, ts ORDER BY event_id DESC) AS r FROM acc) WHERE r = 1),
ev AS (SELECT *, lead(ts) OVER (PARTITION BY {E_KEY} ORDER BY ts) AS n FROM one)
SELECT {_version_cols(E, 'n')} FROM ev"""

ORACLE_SQL["report_scd2_versions"] = _with(E) + f"""SELECT {duck_uuid5(_seed(E))} AS sk_name, user_id, event_type,
  value, ts AS valid_from_sk, nxt AS valid_to, nxt IS NULL AS is_current FROM vw"""

ORACLE_SQL["scd2_current"] = _with(E) + f"""SELECT {duck_uuid5(_seed(E))} AS sk_name_scd2_current, user_id,
  event_type, value, ts AS valid_from_sk, true AS is_current FROM vw WHERE nxt IS NULL"""

ORACLE_SQL["version_counts"] = _with(E) + f"""SELECT {E_KEY}, count(*) AS total_versions,
  min(ts) AS first_version_ts, max(ts) AS last_version_ts FROM vw GROUP BY {E_KEY}"""

ORACLE_SQL["scd2_invariants"] = _with(E) + f"""SELECT {E_KEY}, count(*) AS versions,
  CAST(1 AS BIGINT) AS open_versions, CAST(0 AS BIGINT) AS unlinked, CAST(0 AS BIGINT) AS shared_ends,
  CAST(0 AS BIGINT) AS shared_starts, CAST(0 AS BIGINT) AS bad_flags FROM vw GROUP BY {E_KEY}"""

_GOLD = _with(E, f"""h AS (SELECT {E_KEY}, count(*) AS n, min(ts) AS lo, max(ts) AS hi FROM vw GROUP BY {E_KEY})""",
              "cur AS (SELECT * FROM vw WHERE nxt IS NULL)")

ORACLE_SQL["gold_comparison"] = _GOLD + f"""SELECT cur.{E_KEY},
  cur.event_type AS scd1_event_type, cur.value AS scd1_value, cur.ts AS scd1_last_update,
  {duck_uuid5(_seed(E, 'cur'))} AS sk2_uuid_current, cur.event_type AS scd2_event_type, cur.value AS scd2_value,
  cur.ts AS scd2_last_update, cur.ts AS scd2_valid_from, h.n AS scd2_total_versions, h.lo AS scd2_first_version,
  h.hi AS scd2_latest_version, h.n > 1 AS has_history, '{SCD1_BEHAVIOR}' AS scd1_behavior,
  '{SCD2_BEHAVIOR}' AS scd2_behavior FROM cur JOIN h USING ({E_KEY})"""

ORACLE_SQL["report_comparison"] = _GOLD + f"""SELECT cur.{E_KEY}, {duck_uuid5(_seed(E, 'cur'))} AS sk2_uuid_current,
  cur.event_type AS scd1_event_type, cur.event_type AS scd2_event_type, h.n > 1 AS has_history,
  h.n AS scd2_total_versions FROM cur JOIN h USING ({E_KEY})"""

ORACLE_SQL["gold_comparison_deferred"] = ORACLE_SQL["gold_comparison"]

ORACLE_SQL["history_order"] = _with(E) + "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order FROM vw"

ORACLE_SQL["gold_history"] = _with(E) + f"""SELECT {_version_cols(E).replace(f", {SAP} AS _source_system", "")},
  CASE WHEN nxt IS NULL THEN '{STATE_OPEN}' ELSE '{STATE_CLOSED}' END AS record_state,
  CAST(trunc((floor(epoch(nxt)) - floor(epoch(ts))) / 86400) AS INTEGER) AS days_valid FROM vw"""

_PIT = "TIMESTAMP '2024-01-20 00:00:00'"
_PIT_SELECT = f"""SELECT {duck_uuid5(_seed(E))} AS sk_name, user_id, event_type, value, ts AS valid_from_sk,
  nxt AS valid_to FROM vw WHERE ts <= {_PIT} AND (nxt IS NULL OR nxt > {_PIT})"""

ORACLE_SQL["point_in_time"] = _with(E) + _PIT_SELECT

ORACLE_SQL["point_in_time_key"] = _with(E) + _PIT_SELECT + " AND user_id = 7"

_RUN_TIMES = " ".join(f"WHEN {i} THEN TIMESTAMP '{t}'" for i, t in enumerate(E.run_times))
ORACLE_SQL["commit_log"] = _with(E) + f"""SELECT CAST(b AS BIGINT) AS snapshot_id,
  CASE b {_RUN_TIMES} END AS committed_at, CASE WHEN b = 0 THEN 'append' ELSE 'overwrite' END AS operation,
  count(*) AS added_records, CAST(min(ts) AS VARCHAR) AS min_change_ts, CAST(max(ts) AS VARCHAR) AS max_change_ts
  FROM dd GROUP BY b"""

ORACLE_SQL["as_of_version"] = _events_bronze_latest(upto_batch=1)

ORACLE_SQL["as_of_schema"] = ORACLE_SQL["as_of_version"]

ORACLE_SQL["raw_patch"] = """SELECT c_custkey,
  CASE WHEN c_custkey = 3 THEN 'Customer#000000003 2.0' ELSE c_name END AS c_name,
  c_nationkey,
  CASE WHEN c_custkey = 4 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey = 4 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS c_mktsegment
FROM customer
UNION ALL
SELECT max(c_custkey) + 1, 'Customer#new', 0, 0.0, 'BUILDING' FROM customer"""

ORACLE_SQL["range_clustered"] = _with(E) + f"""SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS overlapping_files FROM orders
UNION ALL SELECT 'scd1', count(DISTINCT {E_KEY}), 0 FROM vw
UNION ALL SELECT 'scd2_current', count(DISTINCT {E_KEY}), 0 FROM vw"""

_LATEST = f"(SELECT *, row_number() OVER (PARTITION BY {E_KEY} ORDER BY b DESC) AS r FROM dd)"
ORACLE_SQL["schema_sync"] = _with(E) + f"""SELECT event_id, user_id, event_type, CASE WHEN b > 0 THEN props END AS props,
  ts AS source_updated_at, {SAP} AS _source_system FROM {_LATEST} WHERE r = 1"""

ORACLE_SQL["schema_ignore"] = _with(E) + f"""SELECT event_id, user_id, event_type, CASE WHEN b = 0 THEN value END AS value,
  ts AS source_updated_at, {SAP} AS _source_system FROM {_LATEST} WHERE r = 1"""

_WIDE = "CASE b WHEN 0 THEN event_id WHEN 1 THEN event_id + 3000000000 WHEN 2 THEN event_id + 0.25 ELSE event_id % 1000 END"
ORACLE_SQL["schema_widen"] = _with(E) + f""", w AS (SELECT *, CAST(CAST({_WIDE} AS DECIMAL(22, 2)) AS VARCHAR) AS number,
  CAST(CASE WHEN b = 2 THEN ts ELSE date_trunc('day', ts) END AS VARCHAR) AS day FROM vw)
SELECT t AS table_name, user_id, number, day, event_type, ts AS source_updated_at, 'decimal(22,2)' AS number_type, 'timestamp_ntz' AS day_type
FROM w, (VALUES ('bronze'), ('scd1'), ('scd2')) AS n(t) WHERE t = 'scd2' OR nxt IS NULL"""

_CUST_SEED = "CAST(c_custkey AS VARCHAR) || '|' || c_name"
ORACLE_SQL["uuid5_key"] = f"""WITH s AS (
  SELECT c_custkey, {_CUST_SEED} AS seed FROM customer
  UNION ALL SELECT -1, CAST(NULL AS VARCHAR) UNION ALL SELECT -2, '' UNION ALL SELECT -3, 'ñandú|日本')
SELECT c_custkey, seed, {duck_uuid5('seed')} AS sk_name FROM s"""

ORACLE_SQL["sql_uuid5"] = f"SELECT c_custkey, {duck_uuid5(_CUST_SEED)} AS sk_name FROM customer"

ORACLE_SQL["key_idempotence"] = _with(E) + f"""SELECT count(*) AS versions, count(DISTINCT {duck_uuid5(_seed(E))}) AS distinct_keys,
  CAST(0 AS BIGINT) AS unstable_rows FROM vw"""

ORACLE_SQL["uuid7_properties"] = """SELECT count(*) AS n_rows, count(*) AS n_distinct, count(*) AS n_version7,
  count(*) AS n_variant_ok, count(*) AS n_len36, count(*) AS n_time_prefix, CAST(0 AS BIGINT) AS n_not_ascending FROM orders"""

_NN_COLS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}
_DIM = {  # rows whose declared columns the checks count: (rows, surrogate key)
    "bronze": ("(SELECT * FROM vw WHERE nxt IS NULL)", None),
    "scd1": ("(SELECT * FROM vw WHERE nxt IS NULL)", f"CAST({E_KEY} AS VARCHAR)"),
    "scd2": ("vw", duck_uuid5(_seed(E))),
    "comparison": ("(SELECT * FROM vw WHERE nxt IS NULL)", None),
    "history": ("vw", duck_uuid5(_seed(E))),
}


def _dim_column(table: str, column: str) -> str:
    return {"sk_name": _DIM[table][1], "is_current": "nxt IS NULL"}.get(column, column)


_DIM_NOT_NULL = (("bronze", E_KEY), ("scd1", "sk_name"), ("scd1", E_KEY), ("scd2", "sk_name"), ("scd2", E_KEY),
                 ("scd2", "is_current"), ("comparison", E_KEY), ("history", "sk_name"), ("history", E_KEY))
ORACLE_SQL["check_not_null"] = _with(E) + "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {t}"
     for t, cols in _NN_COLS.items() for c in cols]
    + [f"SELECT '{t}', '{c}', count(*) FILTER (WHERE ({_dim_column(t, c)}) IS NULL) FROM {_DIM[t][0]}" for t, c in _DIM_NOT_NULL])

_UNIQ = (("orders", "o_orderkey"), ("orders", "o_custkey"), ("documents", "doc_id"), ("documents", "text"))
_DIM_UNIQ = (("bronze", E_KEY), ("scd1", "sk_name"), ("scd1", E_KEY), ("scd2", "sk_name"), ("comparison", E_KEY), ("history", "sk_name"))
ORACLE_SQL["check_unique"] = _with(E) + "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS duplicate_values,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
  FROM (SELECT {x} AS x, count(*) AS n FROM {src} WHERE ({x}) IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""
    for t, c, x, src in [*((t, c, c, t) for t, c in _UNIQ), *((t, c, _dim_column(t, c), _DIM[t][0]) for t, c in _DIM_UNIQ)])
