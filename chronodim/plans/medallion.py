"""Persisted runs of the layered dimension build: raw -> bronze -> type 1 /
type 2 -> gold, over plain partitioned Parquet.

Under ``root``, in one folder per full build (``_base=n``, n the run that began
it):

* ``changes/_commit_id=n``  rows run n accepted; append-only.  Snapshot listing and
  reads as of a run are the operators of ``chronodim.operators.changelog``
  over it.
* ``bronze``, ``scd1``, ``scd2_open``, ``gold_comparison`` by key range
  (``_range=k``): latest state.  A run replaces just the ranges that hold its
  keys (dynamic partition overwrite, see ``chronodim.operators.ranges``).
* ``scd2_closed/_commit_id=n/_span=s``  versions closed by run n, by the block of
  days that holds their interval, so a read at an instant opens matching
  blocks only; ``gold_history/_commit_id=n`` their history rows.
* ``skipped``, ``quarantine``  rows set aside, where asked for.

``runs`` holds one row a run, written last: settings, range bounds, table
columns, watermark and counts.

A failed run is repeated with the same batch: closed versions are derived from
the open ones *as of the run before* (rows carry the run that opened them), the
other tables are upserts.  Each written table is read back before its next
use, which cuts lineage and fixes random type-1 keys.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampNTZType

from chronodim.constants import COMMIT_ID, COMMITTED_AT, DEFAULT_SOURCE_SYSTEM, EMPTY_WATERMARK, IS_CURRENT, OPERATION, SOURCE_TS, VALID_FROM, VALID_TO
from chronodim.functions.intervals import day_span, spans_at
from chronodim.operators.changelog import as_of_version, commit_log, log_entries
from chronodim.operators.dedupe import latest_per_key
from chronodim.operators.gold import compare_dimensions, refresh_comparison, version_history
from chronodim.operators.ingest import accepted_changes, split_bad_casts, to_bronze_rows
from chronodim.operators.merge import upsert
from chronodim.operators.ranges import RANGE, cut_bounds, file_bytes, key_filters, overwrite_ranges, range_of, read_ranges, sized
from chronodim.operators.reads import as_of_time
from chronodim.operators.scd import scd1_apply, scd2_apply_open, scd2_fold, scd2_fold_initial, scd2_versions
from chronodim.operators.schema import conform, evolve, type_changes, widened
from chronodim.operators.watermark import late_rows
from chronodim.plans.session import apply_session_defaults, changes_fit_broadcast, row_bytes

OPENED = "_opened"    # run that opened a version
SPAN = "_span"        # block of days that holds a closed version
HELPERS = (RANGE, OPENED, SPAN, COMMIT_ID)


def _now_text() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def _observed(seen: Observation, df: DataFrame, counted: Sequence[Column]) -> dict:
    """What ``seen`` counted during a write; counted over ``df`` where the
    optimizer dropped the observed plan (an input known to be empty)."""
    try:
        return seen.get
    except Py4JJavaError:
        return df.agg(*counted).first().asDict()


class DimensionStore:
    """A dimension built run by run from raw change batches.

    ``late``: ``"table"`` skips rows at or below the latest change time of the
    whole table, ``"key"`` only rows not newer than their own key's.
    ``on_duplicate``: several changes of a key in one run give its latest row
    (``"latest"``), a version each in type 2 (``"all"``), or an error.
    ``key_ranges``: number of key ranges (default: by size).
    """

    _SETTINGS = ("keys", "ts", "tiebreak", "casts", "source_system", "attrs", "bronze_policy",
                 "scd1_policy", "on_bad_cast", "audit_skipped", "late", "on_duplicate", "key_ranges")

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], ts: str, *,
                 tiebreak: Sequence[str] = (), casts: Mapping[str, str] | None = None,
                 source_system: str = DEFAULT_SOURCE_SYSTEM, attrs: Sequence[str] = (),
                 bronze_policy: str = "sync_all_columns", scd1_policy: str = "sync_all_columns",
                 on_bad_cast: str = "fail", audit_skipped: bool = False,
                 late: str = "table", on_duplicate: str = "latest", key_ranges: int | None = None):
        for name, value, known in (("on_bad_cast", on_bad_cast, ("fail", "quarantine")), ("late policy", late, ("table", "key")),
                                   ("on_duplicate policy", on_duplicate, ("latest", "all", "error"))):
            if value not in known:
                raise ValueError(f"unknown {name} {value!r}")
        apply_session_defaults(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.ts = ts
        self.tiebreak = list(tiebreak)
        self.casts = dict(casts or {})
        self.source_system = source_system
        self.attrs = list(attrs)
        self.bronze_policy = bronze_policy
        self.scd1_policy = scd1_policy
        self.on_bad_cast = on_bad_cast
        self.audit_skipped = bool(audit_skipped)
        self.late = late
        self.on_duplicate = on_duplicate
        self.key_ranges = key_ranges
        self.version = -1
        self._runs: dict[int, dict] = {}
        self.seconds: dict[str, float] = {}  # spent writing each table (its plan included), by this object

    # ------------------------------------------------------------ locations
    def _run(self, v: int | None = None) -> dict:
        """What run ``v`` recorded (one small file, read once)."""
        v = self.version if v is None else v
        if v < 0 or v > self.version:
            raise ValueError(f"no commit {v}; latest is {self.version}")
        if v not in self._runs:
            self._runs[v] = json.loads(self.spark.read.parquet(f"{self.root}/runs/{COMMIT_ID}={v}").first()["run"])
        return self._runs[v]

    def _dir(self, table: str, base: int, commit: int | None = None) -> str:
        path = f"{self.root}/_base={base}/{table}"
        return path if commit is None else f"{path}/{COMMIT_ID}={commit}"

    @staticmethod
    def _columns(run: dict, table: str) -> StructType:
        return StructType.fromJson(json.loads(run["columns"][table]))

    def _timed(self, table: str, began: float) -> None:
        self.seconds[table] = self.seconds.get(table, 0.0) + time.perf_counter() - began

    # ---------------------------------------------------------------- reads
    def _state(self, table: str, run: dict, ranges: Sequence[int] | None = None) -> DataFrame:
        """The latest ``table`` with its helper columns."""
        schema = self._columns(run, table)
        if table not in run["built"]:
            return self.spark.createDataFrame([], schema)
        return read_ranges(self.spark, self._dir(table, run["base"]), schema, ranges)

    def _by_commit(self, table: str, first: int, last: int) -> DataFrame | None:
        """Rows of the runs ``first`` to ``last`` with the newest of their column types.
        Runs in a row with the same columns are one read."""
        parts: list[list] = []
        for c in range(first, last + 1):
            run = self._run(c)
            text = run["commits"].get(table)
            if text is None:
                continue
            if parts and parts[-1][0] == text and parts[-1][1] == run["base"]:
                parts[-1][2].append(c)
            else:
                parts.append([text, run["base"], [c]])
        out, schema = None, None
        for text, base, commits in parts:
            own = StructType.fromJson(json.loads(text))
            schema = own if schema is None else widened(schema, own)
        for text, base, commits in parts:
            own = StructType([*StructType.fromJson(json.loads(text)).fields, StructField(COMMIT_ID, LongType())])
            if table == "scd2_closed":
                own = own.add(SPAN, LongType())
            df = self.spark.read.schema(own).parquet(self._dir(table, base)).where(F.col(COMMIT_ID).between(commits[0], commits[-1]))
            extra = [c for c in (COMMIT_ID, SPAN) if c in df.columns]
            df = conform(df, StructType([*schema.fields, *[own[c] for c in extra]]))
            out = df if out is None else out.unionByName(df)
        return out

    def log(self, v: int | None = None) -> DataFrame:
        """The change log of the complete runs: accepted rows with
        ``_commit_id``, ``_committed_at`` and ``_operation``."""
        v = self.version if v is None else v
        self._run(v)
        return self._by_commit("changes", 0, v)

    def commits(self) -> DataFrame:
        """One row per run: ``snapshot_id, committed_at, operation, summary``."""
        runs = self.spark.read.schema(f"run string, {COMMIT_ID} long").parquet(f"{self.root}/runs").where(F.col(COMMIT_ID) <= F.lit(self.version))
        runs = runs.select(COMMIT_ID, F.get_json_object("run", "$.committed_at").cast("timestamp").alias(COMMITTED_AT), F.get_json_object("run", "$.operation").alias(OPERATION))
        return commit_log(self.log(), runs=runs)

    def bronze(self, v: int | None = None) -> DataFrame:
        """Bronze; as of run ``v`` it is read from the change log, with the
        columns it had."""
        run = self._run(v)
        if v is None or v == self.version:
            return self._state("bronze", run).drop(*HELPERS)
        log = self._by_commit("changes", run["base"], v)
        return conform(as_of_version(log, v, self.keys), StructType([f for f in self._columns(run, "bronze").fields if f.name not in HELPERS]))

    def bronze_as_of(self, v: int) -> DataFrame:
        """Bronze as it was after run ``v``, with the columns it had."""
        return self.bronze(v)

    def scd1(self) -> DataFrame:
        return self._state("scd1", self._run()).drop(*HELPERS)

    def _closed(self, run: dict, after: int, last: int) -> DataFrame:
        """Versions closed by the runs after ``after`` up to ``last``, helpers included."""
        schema = self._columns(run, "scd2_open")
        found = self._by_commit("scd2_closed", max(run["base"], after + 1), last)
        schema = StructType([*schema.fields, StructField(COMMIT_ID, LongType()), StructField(SPAN, LongType())])
        return self.spark.createDataFrame([], schema) if found is None else conform(found, schema)

    def _opened(self, v: int, ranges: Sequence[int] | None = None, leftover: bool = False) -> DataFrame:
        """Versions open after run ``v``, helpers included: those open now, and
        those closed later, if they were opened by then.  ``leftover``: what an
        unfinished run ``v + 1`` has closed counts as closed later."""
        run = self._run(v)
        schema = self._columns(run, "scd2_open")
        last = self._base_end(run["base"])
        state = self._state("scd2_open", self._run(last), ranges)
        if v == last and not leftover:
            return state
        state = conform(state.where(F.col(OPENED) <= v), schema)
        later = self._leftover(self._dir("scd2_closed", run["base"], v + 1), schema) if leftover else self._closed(self._run(last), v, last)
        if later is None:
            return state
        later = later.where(F.col(OPENED) <= v).withColumn(IS_CURRENT, F.lit(True)).withColumn(VALID_TO, F.lit(None).cast(schema[VALID_TO].dataType))
        if ranges is not None:
            later = later.where(F.col(RANGE).isin([int(r) for r in ranges]))
        return state.unionByName(conform(later, schema))

    def _leftover(self, path: str, schema: StructType) -> DataFrame | None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            return None
        return conform(self.spark.read.parquet(path), schema)

    def _base_end(self, base: int) -> int:
        """The last run of the build that began with run ``base``."""
        v = self.version
        while self._run(v)["base"] != base:
            v = self._run(v)["base"] - 1
        return v

    def scd2_current(self, v: int | None = None) -> DataFrame:
        """Open versions as of run ``v``."""
        self._run(v)
        return self._opened(self.version if v is None else v).drop(*HELPERS)

    def scd2(self, v: int | None = None) -> DataFrame:
        """Type-2 table as of run ``v`` (default latest)."""
        run = self._run(v)
        v = self.version if v is None else v
        return self._closed(run, -1, v).drop(*HELPERS).unionByName(self.scd2_current(v))

    def as_of_time(self, instant, key_filter: Column | None = None) -> DataFrame:
        """Versions valid at ``instant``: of the closed ones, only the blocks
        of days that can hold it are read."""
        run = self._run()
        closed = self._closed(run, -1, self.version).where(F.col(SPAN).isin(spans_at(instant)))
        return as_of_time(closed.drop(*HELPERS).unionByName(self.scd2_current()), instant, key_filter)

    def quarantine(self) -> DataFrame:
        """Raw rows set aside because a typed column did not parse."""
        return self._aside("quarantine", "no quarantined rows: the store was not run with on_bad_cast='quarantine'")

    def skipped(self) -> DataFrame:
        """Rows incremental runs skipped as late or without a change time, per
        run; kept with ``audit_skipped=True``."""
        return self._aside("skipped", "no skipped rows kept: run the store with audit_skipped=True")

    def _aside(self, table: str, missing: str) -> DataFrame:
        out = self._by_commit(table, 0, self.version) if self.version >= 0 else None
        if out is None:
            raise ValueError(missing)
        return out

    def watermark(self, v: int | None = None) -> DataFrame:
        """One row ``watermark``: the latest accepted change time."""
        return self.spark.range(1).select(self._watermark_value(self._run(v)).alias("watermark"))

    def _watermark_value(self, run: dict) -> Column:
        """The stored watermark: zone-free text for a zone-free change time,
        else microseconds since the epoch."""
        w, t = run["watermark"], self._columns(run, "bronze")[SOURCE_TS].dataType
        if w is None:
            return F.lit(EMPTY_WATERMARK).cast(t)
        return F.lit(w).cast(t) if isinstance(t, TimestampNTZType) else F.timestamp_micros(F.lit(w).cast("long"))

    def gold_comparison(self) -> DataFrame:
        run = self._run()
        if run["gold_upto"] < 0:
            raise ValueError("gold marts not built")
        return self._state("gold_comparison", run).drop(*HELPERS)

    def gold_history(self, ordered: bool = True) -> DataFrame:
        """History mart in key, start order: the written rows of the closed
        versions, plus the open versions projected on read.  ``ordered=False``
        spares the sort.

        The order comes from the key ranges of the open versions: rows are
        dealt to a task per range and sorted there, without sampling."""
        run = self._run()
        if run["gold_upto"] < 0:
            raise ValueError("gold marts not built")
        opened = version_history(self._opened(run["gold_upto"]), self.keys, run_ts=run["gold_time"], ordered=False)
        closed = self._by_commit("gold_history", run["base"], run["gold_upto"])
        out = opened.drop(OPENED)
        if closed is not None:
            out = out.unionByName(conform(closed.drop(COMMIT_ID), out.schema))
        if not ordered:
            return out.drop(*HELPERS)
        n = len(run["bounds"]) + 1
        return out.repartitionById(n, F.col(RANGE)).sortWithinPartitions(*self.keys, VALID_FROM).drop(*HELPERS)

    def register_views(self, names: Mapping[str, str] | None = None) -> dict[str, str]:
        """Temporary views over the latest tables, so SQL reports run
        unchanged (``SELECT ... FROM silver_scd2 WHERE is_current``)."""
        names = dict(names or {"bronze": "bronze", "scd1": "silver_scd1", "scd2": "silver_scd2",
                               "gold_comparison": "gold_comparison", "gold_history": "gold_history",
                               "log": "change_log", "commits": "snapshots"})
        readers = {"bronze": self.bronze, "scd1": self.scd1, "scd2": self.scd2,
                   "gold_comparison": self.gold_comparison, "gold_history": self.gold_history,
                   "log": self.log, "commits": self.commits}
        for table, view in names.items():
            readers[table]().createOrReplaceTempView(view)
        return names

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "DimensionStore":
        """Reopen a store from its folder at its latest complete run."""
        root = root.rstrip("/")
        runs = spark.read.schema(f"run string, {COMMIT_ID} long").parquet(f"{root}/runs")
        last = runs.agg(F.max_by("run", COMMIT_ID).alias("run"), F.max(COMMIT_ID).alias("n")).first()
        if last["n"] is None:
            raise ValueError(f"no complete run under {root}")
        run = json.loads(last["run"])
        store = cls(spark, root, **run["settings"])
        store.version = int(last["n"])
        store._runs[store.version] = run
        return store

    # ---------------------------------------------------------------- writes
    def _append(self, df: DataFrame, table: str, n: int, run: dict, size: int = 0, by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
        """Write run ``n``'s rows of a table that only grows."""
        began = time.perf_counter()
        run["commits"][table] = StructType([f for f in df.schema.fields if f.name not in partition_by]).json()
        w = (sized(df, by, size) if by else df).write.mode("overwrite")
        if by:
            w = key_filters(w, self.keys)
        w.partitionBy(*partition_by).parquet(self._dir(table, run["base"], n))
        self._timed(table, began)

    def _replace(self, df: DataFrame, table: str, run: dict, size: int) -> None:
        """Write the key ranges that ``df`` holds."""
        began = time.perf_counter()
        run["columns"][table] = df.schema.json()
        if not run["bronze_rows"]:  # nothing yet, so no ranges either
            return
        overwrite_ranges(df, self._dir(table, run["base"]), self.keys, size)
        if table not in run["built"]:
            run["built"].append(table)
        self._timed(table, began)

    # ---------------------------------------------------------------- runs
    def full_refresh(self, raw: DataFrame, run_ts: str | None = None, *, build_gold: bool = True) -> int:
        """A run that builds every table anew from ``raw`` alone.  Earlier
        runs stay readable; type-2 keys come out as before, type-1 keys
        are new."""
        return self.apply(raw, run_ts, build_gold=build_gold, refresh=True)

    def apply(self, raw: DataFrame, run_ts: str | None = None, *, build_gold: bool = True, refresh: bool = False,
              late: str | None = None) -> int:
        """Run one batch of raw rows through every layer; returns its number."""
        apply_session_defaults(self.spark)
        n = self.version + 1
        first = n == 0 or refresh
        run_ts = run_ts or _now_text()
        late = late or self.late
        old = None if first else self._run()
        run = {"settings": {k: getattr(self, k) for k in self._SETTINGS}, "base": n if first else old["base"], "bounds": [] if first else old["bounds"],
               "columns": {} if first else dict(old["columns"]), "built": [] if first else list(old["built"]), "commits": {}, "dropped": [],
               "watermark": None if first else old["watermark"], "gold_upto": -1 if first else old["gold_upto"], "gold_time": None if first else old["gold_time"],
               "committed_at": run_ts, "operation": "append" if n == 0 else "overwrite"}
        bronze = None if first else self.bronze()
        prev_wm = None if first else self._watermark_value(old)

        if self.on_bad_cast == "quarantine":
            raw, bad = split_bad_casts(raw, self.ts, self.casts)
            self._append(bad, "quarantine", n, run)
        typed = to_bronze_rows(raw, self.ts, casts=self.casts, source_system=self.source_system, run_ts=run_ts)
        if late == "key" and run["bounds"]:  # only the key ranges of the batch are read
            near = typed.agg(F.collect_set(range_of(run["bounds"], self.keys, typed.schema)).alias("r")).first().r
            bronze = self._state("bronze", old, near).drop(*HELPERS)
        if self.audit_skipped and not first:
            own = bronze.select(*self.keys, F.col(SOURCE_TS).alias("__own"))
            gone = late_rows(typed, None, watermark=prev_wm) if late == "table" else \
                typed.join(own, self.keys, "left").where(F.col(SOURCE_TS).isNull() | (F.col(SOURCE_TS) <= F.col("__own"))).drop("__own")
            self._append(gone, "skipped", n, run)
        if self.on_duplicate == "error" and typed.groupBy(*self.keys).count().where(F.col("count") > 1).limit(1).count():
            raise ValueError(f"a run holds several changes of one key; on_duplicate='error' ({self.keys})")
        several = self.on_duplicate == "all"
        chg = accepted_changes(raw, bronze, self.keys, self.ts, tiebreak=self.tiebreak, casts=self.casts, source_system=self.source_system, run_ts=run_ts,
                               on_duplicate="keep" if several else "latest", watermark=prev_wm, late=late)
        if several:  # one row per key and change time
            chg = latest_per_key(chg, [*self.keys, SOURCE_TS], self.tiebreak)
        if bronze is not None:
            chg = evolve(bronze, chg, self.bronze_policy)[1]

        # 1. the accepted rows, written once; size, newest change time and
        # touched key ranges are counted as they are written
        entries = log_entries(chg, n, first=n == 0, committed_at=run_ts).drop(COMMIT_ID)
        zone_free = isinstance(entries.schema[SOURCE_TS].dataType, TimestampNTZType)
        newest = F.max(SOURCE_TS).cast("string") if zone_free else F.unix_micros(F.max(SOURCE_TS)).cast("string")
        counted = [F.count(F.lit(1)).alias("added"), F.coalesce(F.sum(row_bytes(entries)), F.lit(0)).alias("size"), newest.alias("newest")]
        if run["bounds"]:
            counted.append(F.collect_set(range_of(run["bounds"], self.keys, entries.schema)).alias("ranges"))
        seen = Observation(f"changes-{n}")
        self._append(entries.observe(seen, *counted), "changes", n, run)
        written = self.spark.read.schema(entries.schema).parquet(self._dir("changes", run["base"], n))
        seen = _observed(seen, written, counted)
        delta, size = written.drop(COMMITTED_AT, OPERATION), seen["size"]
        later = seen["newest"] if zone_free or seen["newest"] is None else int(seen["newest"])
        had = run["watermark"] if zone_free or run["watermark"] is None else int(run["watermark"])
        if later is not None and (had is None or later > had):
            run["watermark"] = seen["newest"]

        run["bronze_rows"] = bool(seen["added"]) or (not first and old["bronze_rows"])

        # 2. key ranges: cut by the first run that brings rows
        if "bronze" not in run["built"] and seen["added"]:
            run["bounds"] = cut_bounds(delta, self.keys, size, self.key_ranges)
        delta = delta.withColumn(RANGE, range_of(run["bounds"], self.keys, delta.schema).cast(IntegerType()))
        fresh = "bronze" not in run["built"]
        ranges = None if fresh else seen.get("ranges", [0] if seen["added"] else [])
        if not fresh:
            had_columns = self._columns(old, "bronze")
            gone = {*old["dropped"], *(set(had_columns.names) - set(delta.columns))}
            if type_changes(had_columns, delta.schema) or gone & set(delta.columns):
                ranges, gone = None, set()  # a widened column, or one that comes back: every range is written anew
            run["dropped"] = sorted(gone)
        small = None if fresh else changes_fit_broadcast(self.spark, seen["added"], size)
        if not fresh and (ranges is None or ranges):
            size += file_bytes(self._state("bronze", run, ranges))
        one = latest_per_key(delta, self.keys, [SOURCE_TS, *self.tiebreak]) if several else delta

        if fresh or ranges is None or ranges:
            # 3. type 2 first: closed versions, then the open ones of its ranges
            if fresh:
                versions = scd2_fold_initial(delta, self.keys, run_ts=run_ts) if several else scd2_versions(delta, self.keys, run_ts=run_ts)
                versions = versions.withColumn(OPENED, F.lit(n).cast("long"))
            else:
                before = self._opened(n - 1, ranges, leftover=True)
                versions = (scd2_fold if several else scd2_apply_open)(delta, before, self.keys, run_ts=run_ts, changes_small=small)
                versions = versions.withColumn(OPENED, F.coalesce(F.col(OPENED), F.lit(n).cast("long")))
            if several or not fresh:
                versions = versions.persist(StorageLevel.DISK_ONLY)  # split into two tables
                closed = versions.where(~F.col(IS_CURRENT)).withColumn(SPAN, day_span(VALID_FROM, VALID_TO))
                self._append(closed, "scd2_closed", n, run, size, [SPAN, *self.keys, VALID_FROM], [SPAN])
            self._replace(versions.where(F.col(IS_CURRENT)), "scd2_open", run, size)
            versions.unpersist()

            # 4. bronze: upsert by key
            state = one if fresh else upsert(evolve(self._state("bronze", run, ranges), one, self.bronze_policy)[0], one, self.keys, small=small)
            self._replace(state, "bronze", run, size)

            # 5. type 1: keys kept for known entities, new uuid v7 otherwise
            wm = prev_wm if late == "table" or fresh else F.lit(EMPTY_WATERMARK).cast(delta.schema[SOURCE_TS].dataType)
            scd1 = scd1_apply(one, None if fresh else self._state("scd1", run, ranges), self.keys, run_ts=run_ts,
                              schema_policy=self.scd1_policy, watermark=wm, changes_small=small)
            self._replace(scd1, "scd1", run, size)
        elif self.bronze_policy == "sync_all_columns":  # no rows, yet perhaps other columns
            run["columns"]["bronze"] = delta.schema.json()
        run["ranges"] = "all" if ranges is None else sorted(ranges)
        run["size"] = size
        self._runs[n] = run
        self.version = n
        if build_gold:
            self._build_gold(run, run_ts)
        self._record(run)
        return n

    def _record(self, run: dict) -> None:
        self.spark.range(1).select(F.lit(json.dumps(run)).alias("run")).write.mode("overwrite").parquet(f"{self.root}/runs/{COMMIT_ID}={self.version}")

    def build_gold(self, run_ts: str | None = None) -> None:
        """Bring both marts up to the latest run, however many runs the last
        build lies back."""
        run = self._run()
        self._build_gold(run, run_ts)
        self._record(run)

    def _build_gold(self, run: dict, run_ts: str | None) -> None:
        n, upto = self.version, run["gold_upto"]
        run_ts = run_ts or _now_text()
        keys = [RANGE, *self.keys]
        since = [self._run(c)["ranges"] for c in range(max(run["base"], upto + 1), n + 1)]
        ranges = None if upto < 0 or "all" in since else sorted({r for c in since for r in c})
        scd1, opened = self._state("scd1", run, ranges), self._state("scd2_open", run, ranges)
        if "gold_comparison" not in run["built"]:
            versions = conform(self._closed(run, -1, n), opened.schema).unionByName(opened)
            comparison = compare_dimensions(scd1, versions, keys, self.attrs, run_ts=run_ts)
        else:
            # only key ranges written since the last build can differ
            comparison = refresh_comparison(self._state("gold_comparison", run, ranges), scd1, opened, self._closed(run, upto, n), keys, self.attrs, run_ts=run_ts)
        if ranges is None or ranges:
            self._replace(comparison, "gold_comparison", run, sum(self._run(c)["size"] for c in range(max(run["base"], upto + 1), n + 1)))
        for c in range(max(run["base"], upto + 1), n + 1):
            # closed rows are final: written once
            closed = self._by_commit("scd2_closed", c, c)
            if closed is not None:
                history = version_history(closed.drop(OPENED, SPAN, COMMIT_ID), self.keys, run_ts=run_ts, ordered=False)
                own = self._run(c)
                self._append(history, "gold_history", c, own, own["size"], [*self.keys, VALID_FROM])
                if c != n:
                    self._runs[c] = own
                    self.spark.range(1).select(F.lit(json.dumps(own)).alias("run")).write.mode("overwrite").parquet(f"{self.root}/runs/{COMMIT_ID}={c}")
        run["gold_upto"], run["gold_time"] = n, run_ts
