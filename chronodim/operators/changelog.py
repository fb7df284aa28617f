"""Change log: every applied change with the commit that applied it.

Replaces table snapshots and time travel of a transactional table format:
the log is append-only (stored partitioned by commit), a snapshot listing is
a group-by over it, and a read "as of version v" is the latest row per key
among commits ``<= v`` (partition-pruned).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronodim.constants import COMMIT_ID, COMMITTED_AT, OPERATION, SOURCE_TS
from chronodim.operators.dedupe import latest_per_key
from chronodim.operators.ingest import audit_time

LOG_COLUMNS = (COMMIT_ID, COMMITTED_AT, OPERATION)


def log_entries(changes: DataFrame, commit_id: int, *, first: bool, committed_at=None) -> DataFrame:
    """Tag one run's applied changes with its commit: id, time, and the
    operation (``append`` for the first load, ``overwrite`` for a merge)."""
    return changes.select(
        "*",
        F.lit(int(commit_id)).cast("long").alias(COMMIT_ID),
        audit_time(committed_at).alias(COMMITTED_AT),
        F.lit("append" if first else "overwrite").alias(OPERATION),
    )


def commit_log(log: DataFrame, ts: str = SOURCE_TS, runs: DataFrame | None = None) -> DataFrame:
    """One row per commit: ``snapshot_id, committed_at, operation, summary``
    where ``summary`` maps ``added-records``, ``min-change-ts`` and
    ``max-change-ts`` to text.  Ordered by commit time.  ``runs``
    (``_commit_id, _committed_at, _operation``) adds the runs that brought no rows."""
    g = log.groupBy(COMMIT_ID).agg(
        F.min(COMMITTED_AT).alias("committed_at"),
        F.min(OPERATION).alias("operation"),
        F.count(F.lit(1)).alias("n"),
        F.min(ts).alias("lo"),
        F.max(ts).alias("hi"),
    )
    if runs is not None:
        empty = runs.join(g.select(COMMIT_ID), COMMIT_ID, "left_anti")
        g = g.unionByName(empty.select(COMMIT_ID, F.col(COMMITTED_AT).alias("committed_at"), F.col(OPERATION).alias("operation"), F.lit(0).cast("long").alias("n")),
                          allowMissingColumns=True)
    summary = F.create_map(
        F.lit("added-records"), F.col("n").cast("string"),
        F.lit("min-change-ts"), F.col("lo").cast("string"),
        F.lit("max-change-ts"), F.col("hi").cast("string"),
    )
    return g.select(F.col(COMMIT_ID).alias("snapshot_id"), "committed_at", "operation",
                    summary.alias("summary")).orderBy("committed_at", "snapshot_id")


def as_of_version(log: DataFrame, version: int, keys: Sequence[str], ts: str = SOURCE_TS) -> DataFrame:
    """The upserted table as it stood after commit ``version``: per key, the
    row of the latest commit ``<= version``.  Log columns are dropped."""
    upto = log.where(F.col(COMMIT_ID) <= F.lit(int(version)))
    latest = latest_per_key(upto, keys, [COMMIT_ID, ts])
    return latest.drop(*LOG_COLUMNS)


def table_from_log(log: DataFrame, keys: Sequence[str], ts: str = SOURCE_TS) -> DataFrame:
    """Latest state of the upserted table rebuilt from the whole log."""
    return latest_per_key(log, keys, [COMMIT_ID, ts]).drop(*LOG_COLUMNS)

