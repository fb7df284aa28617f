"""Table maintenance: range clustering, source patches, staged overwrite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster_by_range(df: DataFrame, columns: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``columns`` and sort inside each partition, so
    written files hold disjoint, ordered key ranges (tight parquet min/max
    statistics for file skipping).  Sampling sets the range bounds; no
    global single-task sort.  Without ``num_partitions`` the partition count
    follows the data: adaptive execution merges small range partitions up to
    the advisory size, so a small part is not split into many tiny files."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, *columns).sortWithinPartitions(*columns)
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def patch_rows(raw: DataFrame, key: str, patches: Mapping[Any, Mapping[str, Any]],
               new_rows: DataFrame | None = None) -> DataFrame:
    """Overwrite columns of a few known keys and append new rows.

    ``patches`` maps key value -> {column: new value}; each patched column is
    one CASE over the key (a narrow projection, no join).  ``new_rows`` is
    appended by position, like ``UNION ALL``.  For many keys use
    :func:`patch_from_frame`.
    """
    by_col: dict[str, list[tuple[Any, Any]]] = {}
    for k, cols in patches.items():
        for c, v in cols.items():
            by_col.setdefault(c, []).append((k, v))
    out_cols = []
    for f in raw.schema.fields:
        if f.name in by_col:
            expr = None
            for k, v in by_col[f.name]:
                cond = F.col(key) == F.lit(k)
                expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
            out_cols.append(expr.otherwise(F.col(f.name)).cast(f.dataType).alias(f.name))
        else:
            out_cols.append(F.col(f.name))
    out = raw.select(*out_cols)
    return out if new_rows is None else out.union(new_rows)


def patch_from_frame(raw: DataFrame, key: str, patch: DataFrame) -> DataFrame:
    """Patch many keys from a frame (``key`` + columns to overwrite; NULL
    keeps the old value): one left join on the key.  A key patched twice
    takes the greater value of each column; rows are never multiplied."""
    patch = patch.groupBy(key).agg(*[F.max(c).alias(c) for c in patch.columns if c != key])
    cols = [c for c in patch.columns if c != key]
    p = patch.select(key, *[F.col(c).alias(f"__p_{c}") for c in cols])
    j = raw.join(p, key, "left")
    return j.select(*[F.coalesce(F.col(f"__p_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in raw.columns])


def overwrite_via_staging(df: DataFrame, target: str, staging: str) -> DataFrame:
    """Replace the table at ``target`` with ``df`` even when ``df`` reads
    ``target``: the new rows are written in full to ``staging``, then two
    renames put them in place (``target`` to ``<target>.replaced``,
    ``staging`` to ``target``).  At every moment one complete copy exists; the
    old one goes last."""
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(staging)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, here, old = path(staging), path(target), path(f"{target.rstrip('/')}.replaced")
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(here) and not fs.rename(here, old):
        raise OSError(f"could not move {target} aside; the new rows are in {staging}")
    if not fs.rename(new, here):
        raise OSError(f"could not move {staging} to {target}; the old rows are in {target}.replaced")
    fs.delete(old, True)
    spark.catalog.refreshByPath(target)
    return spark.read.parquet(target)
