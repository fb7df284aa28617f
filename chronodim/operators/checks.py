"""Data checks: not-null, unique, key idempotence, type-2 interval soundness.

Every check is an aggregation that runs distributed and returns a small
DataFrame of failures; nothing is collected by the library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronodim.constants import IS_CURRENT, SK, VALID_FROM, VALID_TO


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for each column, from one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at least one NULL (the ``not_null`` test fails on them)."""
    return null_counts(df, columns).where(F.col("null_count") > 0)


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of ``columns`` occurring more than once, with their count.
    NULL values are not tested.

    Wide values (text) are counted by a 256-bit digest and the length, so
    only these are shuffled; the values themselves are compared among the rows
    of digests met twice.  Counted with a partial aggregate, so a hot value is
    combined map-side."""
    cols = list(columns)
    nonnull = df
    for c in cols:
        nonnull = nonnull.where(F.col(c).isNotNull())
    wide = [c for c in cols if df.schema[c].dataType.typeName() in ("string", "binary")]
    if wide:
        digest = F.struct(*[F.struct(F.sha2(F.col(c).cast("binary"), 256), F.octet_length(c)) if c in wide else F.col(c) for c in cols])
        keyed = nonnull.select(*cols, digest.alias("__digest"))
        twice = keyed.groupBy("__digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("__digest")
        nonnull = keyed.join(twice, "__digest", "left_semi").drop("__digest")
    return nonnull.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def uniqueness_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: number of duplicated values and of rows carrying them."""
    d = duplicate_groups(df, columns)
    return d.agg(F.count(F.lit(1)).alias("duplicate_values"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows"))


def key_idempotence(stored: DataFrame, recomputed: DataFrame, keys: Sequence[str], start: str = VALID_FROM, sk: str = SK) -> DataFrame:
    """Version keys of a table against those of an independent rebuild:
    versions, distinct keys, and versions whose key differs or that only one
    of the tables has."""
    a = stored.select(*keys, start, F.col(sk).alias("__a"))
    b = recomputed.select(*keys, start, F.col(sk).alias("__b"))
    both = a.join(b, [*keys, start], "full_outer")
    return both.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_distinct("__a").alias("distinct_keys"),
        F.count_if(~F.col("__a").eqNullSafe(F.col("__b"))).alias("unstable_rows"),
    )


def file_overlaps(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows of a table read from files, and the number of files whose
    key range reaches into that of the files before (0 when clustered)."""
    key = F.struct(*[F.col(k) for k in keys])
    files = df.select(key.alias("k"), F.input_file_name().alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    # one row a file
    seen = W.orderBy("lo", "f").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("before", F.max("hi").over(seen)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.count_if(F.col("lo") <= F.col("before")).alias("overlapping_files"))


def scd2_interval_report(scd2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: ``versions``, ``open_versions``, ``unlinked`` (closed versions
    whose end is not the start of another version: a gap), ``shared_ends``
    and ``shared_starts`` (overlaps), ``bad_flags`` (``valid_to`` NULL not
    matching ``is_current``, or an empty/negative interval).

    A key is sound when it has exactly one open version and all other
    counts are zero: then its versions form one chain without gaps or
    overlaps.  Built from aggregates and a join on (key, instant), never a
    window over a whole key, so a key with very many versions does not land
    in one task.
    """
    keys = list(keys)
    v = scd2.select(*keys, VALID_FROM, VALID_TO, IS_CURRENT)
    bad = (F.col(VALID_TO).isNull() != F.coalesce(F.col(IS_CURRENT), F.lit(False))) | (F.col(VALID_TO) <= F.col(VALID_FROM))
    # starts and ends by (key, instant), then by key: two shuffles
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    starts = v.select(*keys, F.col(VALID_FROM).alias("t"), one.alias("s"), zero.alias("e"), F.coalesce(F.col(IS_CURRENT), F.lit(False)).cast("long").alias("o"),
                      F.coalesce(bad, F.lit(False)).cast("long").alias("b"))
    ends = v.where(F.col(VALID_TO).isNotNull()).select(*keys, F.col(VALID_TO).alias("t"), zero.alias("s"), one.alias("e"), zero.alias("o"), zero.alias("b"))
    at = starts.unionByName(ends).groupBy(*keys, "t").agg(*[F.sum(c).alias(c) for c in "seob"])
    return at.groupBy(*keys).agg(
        F.sum("s").alias("versions"), F.sum("o").alias("open_versions"),
        F.sum(F.when(F.col("s") == 0, F.col("e")).otherwise(0)).cast("long").alias("unlinked"),
        F.sum(F.greatest(F.col("e") - 1, zero)).alias("shared_ends"), F.sum(F.greatest(F.col("s") - 1, zero)).alias("shared_starts"),
        F.sum("b").alias("bad_flags"))


def scd2_violations(scd2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose versions do not form one sound chain."""
    r = scd2_interval_report(scd2, keys)
    return r.where((F.col("open_versions") != 1) | (F.col("unlinked") > 0) | (F.col("shared_ends") > 0)
                   | (F.col("shared_starts") > 0) | (F.col("bad_flags") > 0))
