"""Bronze layer: typed projection, audit columns, watermark filter, upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from chronodim.constants import DEFAULT_SOURCE_SYSTEM, INGESTED_AT, SOURCE_SYSTEM, SOURCE_TS
from chronodim.operators.dedupe import latest_per_key
from chronodim.operators.keyfilter import can_filter, key_filter, may_hold
from chronodim.operators.merge import upsert
from chronodim.operators.watermark import above_watermark


def audit_time(run_ts: str | Column | None) -> Column:
    """Audit timestamp: the query start time, or a fixed run time so a run
    can be replayed with identical output."""
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp")
    return F.lit(str(run_ts)).cast("timestamp")


def to_bronze_rows(raw: DataFrame, ts: str, *, casts: Mapping[str, str] | None = None,
                   source_system: str = DEFAULT_SOURCE_SYSTEM, run_ts: str | Column | None = None) -> DataFrame:
    """Project raw rows to the bronze shape: business columns in raw order
    (typed per ``casts``), the change time as ``source_updated_at``, then
    ``_ingested_at`` and ``_source_system``.

    A change time already typed as a timestamp (with or without zone) keeps
    its type; text is cast to ``timestamp``.
    """
    casts = dict(casts or {})
    cols: list[Column] = []
    for f in raw.schema.fields:
        if f.name == ts:
            continue
        c = F.col(f.name)
        if f.name in casts:
            c = c.cast(casts[f.name])
        cols.append(c.alias(f.name))
    ts_type = raw.schema[ts].dataType
    ts_col = F.col(ts) if isinstance(ts_type, (TimestampType, TimestampNTZType)) else F.col(ts).cast("timestamp")
    if isinstance(ts_type, DateType):
        ts_col = F.col(ts).cast("timestamp")
    return raw.select(
        *cols,
        ts_col.alias(SOURCE_TS),
        audit_time(run_ts).alias(INGESTED_AT),
        F.lit(source_system).alias(SOURCE_SYSTEM),
    )


def _typed_columns(raw: DataFrame, ts: str, casts: Mapping[str, str]) -> dict[str, str]:
    """Text columns the bronze projection casts, with their target type."""
    out = {c: t for c, t in casts.items() if c in raw.columns}
    if ts in raw.columns and not isinstance(raw.schema[ts].dataType, (TimestampType, TimestampNTZType)):
        out.setdefault(ts, "timestamp")
    return out


def split_bad_casts(raw: DataFrame, ts: str, casts: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: rows whose typed columns all parse, and rows where some
    non-NULL value does not (``try_cast`` gives NULL), with the failing
    column names in ``_bad_columns``.  Lets a run quarantine malformed source
    rows instead of failing on an ANSI cast error."""
    typed = _typed_columns(raw, ts, dict(casts or {}))
    if not typed:
        return raw, raw.limit(0).withColumn("_bad_columns", F.array().cast("array<string>"))
    fails = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in typed.items()}
    any_bad = reduce(lambda a, b: a | b, fails.values())
    bad = raw.where(any_bad).withColumn(
        "_bad_columns", F.filter(F.array(*[F.when(f, F.lit(c)) for c, f in fails.items()]), lambda x: x.isNotNull()))
    return raw.where(~any_bad), bad


def accepted_changes(raw: DataFrame, state: DataFrame | None, keys: Sequence[str], ts: str, *,
                     tiebreak: Sequence[str] = (), casts: Mapping[str, str] | None = None,
                     source_system: str = DEFAULT_SOURCE_SYSTEM, run_ts: str | Column | None = None,
                     on_duplicate: str = "latest", watermark: Column | None = None, late: str = "table") -> DataFrame:
    """The rows one run applies to bronze: typed, above the watermark of
    ``state`` (no filter on the first run, ``state is None``), one per key.
    ``watermark`` (a scalar column) replaces the scan of ``state`` for its
    latest change time when the caller keeps that value.

    ``on_duplicate``: ``"latest"`` keeps the latest row per key (ties broken
    by ``tiebreak`` then by a hash of the other columns); ``"keep"`` keeps all
    rows as a first-run load without merge does.

    ``late="key"`` compares a row with its own key's change time in ``state``
    instead of the table-wide watermark: a key not yet known is never late.
    State keys that no change has are dropped by a Bloom filter of the change
    keys (``key_filter``, of bounded size) before the join shuffles them.
    """
    rows = to_bronze_rows(raw, ts, casts=casts, source_system=source_system, run_ts=run_ts)
    if state is not None and late == "key":
        own = state.select(*keys, F.col(SOURCE_TS).alias("__own"))
        cols = rows.columns
        rows = rows.where(F.col(SOURCE_TS).isNotNull())
        if can_filter(rows, own, keys):
            own = may_hold(own, key_filter(rows, keys), keys)
        if on_duplicate == "latest":  # fewer rows to join
            rows = latest_per_key(rows, keys, [SOURCE_TS, *tiebreak])
        rows = rows.join(own, list(keys), "left").where(F.col("__own").isNull() | (F.col(SOURCE_TS) > F.col("__own"))).select(*cols)
    elif watermark is not None:
        rows = rows.where(F.col(SOURCE_TS) > watermark)
    elif state is not None:
        rows = above_watermark(rows, state, SOURCE_TS, SOURCE_TS)
    if on_duplicate == "latest":
        rows = latest_per_key(rows, keys, [SOURCE_TS, *tiebreak])
    elif on_duplicate != "keep":
        raise ValueError(f"unknown on_duplicate policy {on_duplicate!r}")
    return rows


def bronze_ingest(raw: DataFrame, state: DataFrame | None, keys: Sequence[str], ts: str, *,
                  tiebreak: Sequence[str] = (), casts: Mapping[str, str] | None = None,
                  source_system: str = DEFAULT_SOURCE_SYSTEM, run_ts: str | Column | None = None,
                  on_duplicate: str = "latest") -> DataFrame:
    """New bronze state after one run: first run loads everything, later runs
    upsert the rows above the watermark by natural key."""
    changes = accepted_changes(raw, state, keys, ts, tiebreak=tiebreak, casts=casts,
                               source_system=source_system, run_ts=run_ts, on_duplicate=on_duplicate)
    if state is None:
        return changes
    return upsert(state, changes, keys)
