"""Slowly changing dimensions.

Type 1 (:func:`scd1_apply`): one row per key, attributes overwritten, a
time-ordered surrogate key assigned once and kept.

Type 2 (:func:`scd2_apply`): one row per version; an update closes the open
version (``is_current = false``, ``valid_to`` = new change time) and opens a
new one whose key is the uuid v5 of ``key | change time``.  Validity is the
half-open interval ``[valid_from_sk, valid_to)``.

All operators are pure: ``(changes, state) -> new state``; ``state is None``
means a first (or full-refresh) run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronodim.constants import (
    INGESTED_AT,
    IS_CURRENT,
    SILVER_CREATED_AT,
    SILVER_UPDATED_AT,
    SK,
    SOURCE_SYSTEM,
    SOURCE_TS,
    UUID5_NAMESPACE,
    VALID_FROM,
    VALID_TO,
)
from chronodim.functions.keys import uuid5, uuid7, version_seed
from chronodim.operators.dedupe import latest_per_key
from chronodim.operators.ingest import audit_time
from chronodim.operators.merge import keyed_outer_join
from chronodim.operators.schema import align_types, conform
from chronodim.operators.watermark import watermark_value

SCD2_DERIVED = (SK, VALID_FROM, VALID_TO, IS_CURRENT, SILVER_CREATED_AT, SOURCE_SYSTEM)


def _source_col(df: DataFrame) -> Column:
    return F.col(SOURCE_SYSTEM) if SOURCE_SYSTEM in df.columns else F.lit(None).cast("string")


def _aligned(df: DataFrame, columns: Sequence[str], like: DataFrame | None) -> list[Column]:
    """``columns`` taken from ``df``, NULL where ``df`` lacks one; cast to the
    type of ``like`` (the target table) when given."""
    out = []
    for c in columns:
        col = F.col(c) if c in df.columns else F.lit(None)
        if like is not None and c in like.columns:
            col = col.cast(like.schema[c].dataType)
        out.append(col.alias(c))
    return out


def is_open(current: str = IS_CURRENT) -> Column:
    return F.coalesce(F.col(current), F.lit(False))


# --------------------------------------------------------------------- type 1
def scd1_apply(changes: DataFrame, state: DataFrame | None, keys: Sequence[str], *,
               ts: str = SOURCE_TS, run_ts=None, schema_policy: str = "sync_all_columns",
               watermark: Column | None = None, changes_small: bool | None = None,
               key_partitions: int | None = None) -> DataFrame:
    """New type-1 state.

    Rows of ``changes`` (bronze rows) above the watermark of ``state`` update
    their key's attributes; the key's ``sk_name`` is kept when the key exists
    and generated (uuid v7) otherwise.  Keys absent from ``changes`` are kept.

    One outer join of state and changes on the key (``keyed_outer_join``:
    the state is streamed without a shuffle when the change set is proven
    small); random keys are generated only for rows that need one.  Persist
    the result before reading it twice, since new keys are random.
    ``watermark`` replaces the scan of ``state`` for its latest change time
    when the caller keeps it.
    """
    keys = list(keys)
    now = audit_time(run_ts)
    if state is None:
        chg = changes
    else:
        wm = watermark if watermark is not None else watermark_value(state, ts)
        state, changes = align_types(state, changes)
        chg = changes.where(F.col(ts) > wm)
    biz = [c for c in chg.columns if c not in (INGESTED_AT, SOURCE_SYSTEM, SILVER_UPDATED_AT, SK)]
    if state is None:
        return chg.select(uuid7(now).alias(SK), *[F.col(c) for c in biz],
                          now.alias(SILVER_UPDATED_AT), _source_col(chg).alias(SOURCE_SYSTEM))

    if schema_policy == "ignore":
        out_cols = list(state.columns)
    elif schema_policy == "sync_all_columns":
        out_cols = [SK, *biz, SILVER_UPDATED_AT, SOURCE_SYSTEM]
    else:
        raise ValueError(f"unknown schema policy {schema_policy!r}")
    new_cols = [c for c in out_cols if c not in keys and c not in (SK, SILVER_UPDATED_AT)]
    t = state.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in state.columns if c not in keys])
    b = chg.select(*keys, *_aligned(chg.withColumn(SOURCE_SYSTEM, _source_col(chg)), new_cols, state),
                   F.lit(True).alias("__hit"))
    b = b.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in new_cols], "__hit")
    j = keyed_outer_join(t, b, keys, small=changes_small, key_partitions=key_partitions)
    hit = F.col("__hit").isNotNull()

    def old(c: str) -> Column:
        return F.col(f"__t_{c}") if c in state.columns else F.lit(None)

    cols = []
    for c in out_cols:
        if c in keys:
            cols.append(F.col(c))
        elif c == SK:
            cols.append(F.when(hit, F.coalesce(old(SK), uuid7(now))).otherwise(old(SK)).alias(SK))
        elif c == SILVER_UPDATED_AT:
            cols.append(F.when(hit, now).otherwise(old(c)).alias(c))
        else:
            cols.append(F.when(hit, F.col(f"__b_{c}")).otherwise(old(c)).alias(c))
    return j.select(*cols)


# --------------------------------------------------------------------- type 2
def scd2_versions(changes: DataFrame, keys: Sequence[str], *, ts: str = SOURCE_TS, run_ts=None,
                  namespace: str = UUID5_NAMESPACE, like: DataFrame | None = None) -> DataFrame:
    """Open versions for ``changes``: deterministic key, ``valid_from_sk`` =
    change time, open end typed like the change time, ``is_current`` true.

    With ``like`` (the existing table, policy ``ignore``) the business
    columns and types follow the table: new source columns are ignored and
    missing ones are NULL.
    """
    keys = list(keys)
    if like is None:
        biz = [c for c in changes.columns if c not in (INGESTED_AT, *SCD2_DERIVED)]
        ts_type = changes.schema[ts].dataType
    else:
        biz = [c for c in like.columns if c not in SCD2_DERIVED]
        ts_type = like.schema[VALID_TO].dataType
    out = changes.select(
        uuid5(version_seed(keys, ts), namespace).alias(SK),
        *_aligned(changes, biz, like),
        F.col(ts).cast(ts_type).alias(VALID_FROM),
        F.lit(None).cast(ts_type).alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
        audit_time(run_ts).alias(SILVER_CREATED_AT),
        _source_col(changes).alias(SOURCE_SYSTEM),
    )
    return out if like is None else out.select(*like.columns)


def scd2_initial(changes: DataFrame, keys: Sequence[str], *, ts: str = SOURCE_TS, run_ts=None,
                 namespace: str = UUID5_NAMESPACE) -> DataFrame:
    """First run: one open version per key of ``changes``."""
    return scd2_versions(latest_per_key(changes, keys, [ts]), keys, ts=ts, run_ts=run_ts, namespace=namespace)


def scd2_close(state: DataFrame, changes: DataFrame, keys: Sequence[str], *, ts: str = SOURCE_TS,
               small: bool = False) -> DataFrame:
    """Close the open version of every key that has a newer change:
    ``is_current = false``, ``valid_to`` = the change time.  Other rows are
    unchanged.  The newest change per key is taken, so one open version
    maps to one update.  ``small``: the caller has proven the change set small
    enough to broadcast; else adaptive execution chooses the join."""
    keys = list(keys)
    newest = changes.groupBy(*keys).agg(F.max(ts).alias("__new_ts"))
    if small:
        newest = F.broadcast(newest)
    cur = state.where(is_open())
    hist = state.where(~is_open())
    j = cur.join(newest, keys, "left")
    close = F.coalesce(F.col("__new_ts") > F.col(ts), F.lit(False))
    cols = []
    for c in state.columns:
        if c == IS_CURRENT:
            cols.append(F.when(close, F.lit(False)).otherwise(F.col(c)).alias(c))
        elif c == VALID_TO:
            cols.append(F.when(close, F.col("__new_ts").cast(state.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return hist.unionByName(j.select(*cols))


def scd2_new_versions(changes: DataFrame, state: DataFrame, keys: Sequence[str], *, ts: str = SOURCE_TS,
                      run_ts=None, namespace: str = UUID5_NAMESPACE) -> DataFrame:
    """Versions to append after closing: the newest change of each key that
    has no open version, or is newer than the open one."""
    keys = list(keys)
    changes = latest_per_key(changes, keys, [ts])
    opened = state.where(is_open()).select(*keys, F.col(ts).alias("__open_ts"), F.lit(True).alias("__open"))
    j = changes.join(opened, keys, "left")
    fresh = j.where(F.col("__open").isNull() | (F.col(ts) > F.col("__open_ts"))).drop("__open_ts", "__open")
    return scd2_versions(fresh, keys, ts=ts, run_ts=run_ts, namespace=namespace, like=state)


def scd2_apply_open(changes: DataFrame, current: DataFrame, keys: Sequence[str], *, ts: str = SOURCE_TS,
                    run_ts=None, namespace: str = UUID5_NAMESPACE, changes_small: bool | None = None,
                    key_partitions: int | None = None) -> DataFrame:
    """One run of type 2 over the open versions only.

    Returns the rows whose state is decided by this run: every open version
    (kept, or closed by a newer change) plus the new open versions.  Closed
    history is not read; a store appends the closed rows and replaces the
    open ones.

    Plan: the change set is reduced to one row per key (partial aggregate),
    then one outer join with the open versions on the key
    (``keyed_outer_join``: no shuffle of the open versions when the change
    set is proven small), whose output is expanded to at most two rows per
    key (closed old, new open).  Both inputs hold at most one row per key,
    so no key can skew the join.
    """
    keys = list(keys)
    current, changes = align_types(current, changes)
    # reduce first (map-side combine keeps a hot key cheap), then, for a
    # bucketed state, lay the one-row-per-key result out in its buckets
    latest = latest_per_key(changes, keys, [ts])
    vers = scd2_versions(latest, keys, ts=ts, run_ts=run_ts, namespace=namespace, like=current)
    cols = list(current.columns)
    t = current.select(*keys, F.struct(*cols).alias("__t"), F.col(ts).alias("__t_ts"))
    b = vers.select(*keys, F.struct(*cols).alias("__b"), F.col(ts).alias("__b_ts"))
    j = keyed_outer_join(t, b, keys, small=changes_small, key_partitions=key_partitions)
    has_t = F.col("__t").isNotNull()
    has_b = F.col("__b").isNotNull()
    newer = F.coalesce(F.col("__b_ts") > F.col("__t_ts"), F.lit(False))
    closed = (F.col("__t").withField(IS_CURRENT, F.lit(False))
              .withField(VALID_TO, F.col("__b_ts").cast(current.schema[VALID_TO].dataType)))
    old = F.when(has_t & has_b & newer, closed).when(has_t, F.col("__t"))
    new = F.when(has_b & (~has_t | newer), F.col("__b"))
    return (j.select(F.explode(F.array(old, new)).alias("__v"))
            .where(F.col("__v").isNotNull())
            .select("__v.*"))


def scd2_apply(changes: DataFrame, state: DataFrame | None, keys: Sequence[str], *, ts: str = SOURCE_TS,
               run_ts=None, namespace: str = UUID5_NAMESPACE) -> DataFrame:
    """New type-2 state: closed history passes through, open versions are
    resolved by :func:`scd2_apply_open`.  Equal to close then append."""
    if state is None:
        return scd2_initial(changes, keys, ts=ts, run_ts=run_ts, namespace=namespace)
    new = scd2_apply_open(changes, state.where(is_open()), keys, ts=ts, run_ts=run_ts, namespace=namespace)
    return conform(state.where(~is_open()), new.schema).unionByName(new)


# --------------------------------------------------- several changes of a key
NEXT = "__next"
BUCKET_SECONDS = 3600


def with_next_change(changes: DataFrame, keys: Sequence[str], *, ts: str = SOURCE_TS, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``changes`` (one row per key and change time) with ``__next``, the
    key's next change time.

    The next row is looked for among those of the same key and hour
    (``bucket_seconds``) first; the last one of an hour takes the first of the
    key's next hour that has any, from a table of one row per key and hour.  So a
    key with a large share of the rows is split by time over many tasks.
    """
    keys = list(keys)
    hour = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / bucket_seconds)
    rows = changes.withColumn("__hour", hour)
    inside = F.lead(ts).over(W.partitionBy(*keys, "__hour").orderBy(ts))
    firsts = rows.groupBy(*keys, "__hour").agg(F.min(ts).alias("__first"))
    firsts = firsts.withColumn("__after", F.lead("__first").over(W.partitionBy(*keys).orderBy("__hour"))).drop("__first")
    firsts = firsts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__hour").alias("__h"), "__after")
    same = F.col("__hour").eqNullSafe(F.col("__h"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return rows.withColumn(NEXT, inside).join(firsts, same, "left").select(*changes.columns, F.coalesce(NEXT, "__after").alias(NEXT))


def _without_unchanged(changes: DataFrame, keys: Sequence[str], ts: str, bucket_seconds: int) -> DataFrame:
    """Drops changes whose attributes equal those of the key's change before,
    where both lie in one hour (so no key is ordered in one task)."""
    biz = [c for c in changes.columns if c not in (*keys, ts, INGESTED_AT, SOURCE_SYSTEM)]
    same = F.struct(*[F.col(c) for c in biz])
    hour = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / bucket_seconds)
    w = W.partitionBy(*keys, "__hour").orderBy(ts)
    rows = changes.withColumn("__hour", hour).withColumn("__same", same)
    rows = rows.withColumn("__before", F.lag("__same").over(w))
    return rows.where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(F.col("__same"))).select(*changes.columns)


def _linked(changes: DataFrame, keys: Sequence[str], ts: str, run_ts, namespace: str, like: DataFrame | None, bucket_seconds: int) -> DataFrame:
    """A version per change, each closed by the next one of its key."""
    rows = with_next_change(changes, keys, ts=ts, bucket_seconds=bucket_seconds)
    if like is not None:
        like = like.withColumn(NEXT, F.lit(None).cast(like.schema[VALID_TO].dataType))
    v = scd2_versions(rows, keys, ts=ts, run_ts=run_ts, namespace=namespace, like=like)
    end = F.col(NEXT).cast(v.schema[VALID_TO].dataType)
    return v.withColumn(VALID_TO, end).withColumn(IS_CURRENT, end.isNull()).drop(NEXT)


def scd2_fold_initial(changes: DataFrame, keys: Sequence[str], *, ts: str = SOURCE_TS, run_ts=None, namespace: str = UUID5_NAMESPACE,
                      drop_unchanged: bool = False, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """First run with a version for every change of a key (``changes``: one
    row per key and change time)."""
    if drop_unchanged:
        changes = _without_unchanged(changes, keys, ts, bucket_seconds)
    return _linked(changes, keys, ts, run_ts, namespace, None, bucket_seconds)


def scd2_fold(changes: DataFrame, current: DataFrame, keys: Sequence[str], *, ts: str = SOURCE_TS, run_ts=None, namespace: str = UUID5_NAMESPACE,
              changes_small: bool | None = None, drop_unchanged: bool = False, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """:func:`scd2_apply_open` with a version for every change of a key that is
    newer than its open version, not only for the latest: the open version ends
    at the first of them, each of them at the next, the last stays open.

    ``changes`` holds one row per key and change time.  The open versions hold one
    row per key; hot keys of ``changes`` are split by time (see
    :func:`with_next_change`) and by adaptive execution in the join.
    """
    keys = list(keys)
    current, changes = align_types(current, changes)
    cols = list(current.columns)
    opened = current.select(*keys, F.col(ts).alias("__open_ts"), F.lit(True).alias("__open"))
    newer = changes.join(opened, keys, "left").where(F.col("__open").isNull() | (F.col(ts) > F.col("__open_ts"))).select(*changes.columns)
    if drop_unchanged:
        newer = _without_unchanged(newer, keys, ts, bucket_seconds)
    new = _linked(newer, keys, ts, run_ts, namespace, current, bucket_seconds).select(*cols)
    ends = newer.groupBy(*keys).agg(F.min(ts).alias("__end"))
    if changes_small:
        ends = F.broadcast(ends)  # one row a key of a change set proven small
    end = F.col("__end").cast(current.schema[VALID_TO].dataType)
    old = current.join(ends, keys, "left").withColumn(VALID_TO, F.coalesce(end, F.col(VALID_TO))).withColumn(IS_CURRENT, F.col("__end").isNull()).select(*cols)
    return old.unionByName(new)
