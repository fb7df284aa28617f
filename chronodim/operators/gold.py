"""Gold marts: type-1 vs type-2 comparison, and version history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronodim.constants import (
    GOLD_CREATED_AT,
    IS_CURRENT,
    SCD1_BEHAVIOR,
    SCD2_BEHAVIOR,
    SILVER_CREATED_AT,
    SK,
    SOURCE_SYSTEM,
    SOURCE_TS,
    STATE_CLOSED,
    STATE_OPEN,
    VALID_FROM,
    VALID_TO,
)
from chronodim.functions.intervals import whole_days
from chronodim.operators.ingest import audit_time


def version_counts(scd2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: number of versions, first and latest version start.
    Partial + final hash aggregate, so a key with many versions is
    combined map-side."""
    return scd2.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_versions"),
        F.min(VALID_FROM).alias("first_version_ts"),
        F.max(VALID_FROM).alias("last_version_ts"),
    )


def compare_dimensions(scd1: DataFrame, scd2: DataFrame, keys: Sequence[str], attrs: Sequence[str], *,
                       run_ts=None) -> DataFrame:
    """Side-by-side view of type 1 and type 2 per key of ``scd1``.

    ``scd1 LEFT JOIN open versions LEFT JOIN version counts`` on the key.
    The three inputs are hash-partitioned on the same key, so the second
    join reuses the first join's partitioning (three shuffles, none
    repeated); the count side is aggregated before its shuffle.
    """
    keys = list(keys)
    s1 = scd1.select(*keys, F.col(SK).alias("sk1_uuid"), *[F.col(a).alias(f"scd1_{a}") for a in attrs],
                     F.col(SOURCE_TS).alias("scd1_last_update"))
    s2 = scd2.where(F.col(IS_CURRENT) == F.lit(True)).select(
        *keys, F.col(SK).alias("sk2_uuid_current"), *[F.col(a).alias(f"scd2_{a}") for a in attrs],
        F.col(SOURCE_TS).alias("scd2_last_update"), F.col(VALID_FROM).alias("scd2_valid_from"))
    h = version_counts(scd2, keys)
    j = s1.join(s2, keys, "left").join(h, keys, "left")
    return j.select(
        *keys,
        "sk1_uuid", *[f"scd1_{a}" for a in attrs], "scd1_last_update",
        "sk2_uuid_current", *[f"scd2_{a}" for a in attrs], "scd2_last_update", "scd2_valid_from",
        F.col("total_versions").alias("scd2_total_versions"),
        F.col("first_version_ts").alias("scd2_first_version"),
        F.col("last_version_ts").alias("scd2_latest_version"),
        F.when(F.col("total_versions") > 1, F.lit(True)).otherwise(F.lit(False)).alias("has_history"),
        F.lit(SCD1_BEHAVIOR).alias("scd1_behavior"),
        F.lit(SCD2_BEHAVIOR).alias("scd2_behavior"),
        audit_time(run_ts).alias(GOLD_CREATED_AT),
    )


def refresh_comparison(prev: DataFrame, scd1: DataFrame, scd2_open: DataFrame, closed_since: DataFrame,
                       keys: Sequence[str], attrs: Sequence[str], *, run_ts=None) -> DataFrame:
    """The comparison mart from the previous one, for the keys of ``scd1``.

    ``prev``, ``scd1`` and ``scd2_open`` hold one row per key (of the key
    ranges that changed); ``closed_since`` holds the versions closed since
    ``prev`` was built, by however many runs.  A key's versions are those
    counted before (whose open one is either still open or among the closed),
    the closed ones since, and the open one.  Older history is not read.

    Three left joins on one key: each input is laid out by the key once.
    """
    keys = list(keys)
    s1 = scd1.select(*keys, F.col(SK).alias("sk1_uuid"), *[F.col(a).alias(f"scd1_{a}") for a in attrs],
                     F.col(SOURCE_TS).alias("scd1_last_update"))
    s2 = scd2_open.select(*keys, F.col(SK).alias("sk2_uuid_current"), *[F.col(a).alias(f"scd2_{a}") for a in attrs],
                          F.col(SOURCE_TS).alias("scd2_last_update"), F.col(VALID_FROM).alias("scd2_valid_from"))
    p = prev.select(*keys, F.col("scd2_valid_from").alias("__p_open"), F.col("scd2_total_versions").alias("__p_n"),
                    F.col("scd2_first_version").alias("__p_first"), F.col("scd2_latest_version").alias("__p_last"))
    c = closed_since.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c_n"), F.min(VALID_FROM).alias("__c_first"),
                                        F.max(VALID_FROM).alias("__c_last"))
    j = s1.join(s2, keys, "left").join(p, keys, "left").join(c, keys, "left")
    before = F.coalesce(F.col("__p_n"), F.lit(0)) - F.col("__p_open").isNotNull().cast("long")
    total = before + F.coalesce(F.col("__c_n"), F.lit(0)) + F.col("scd2_valid_from").isNotNull().cast("long")
    total = F.when(total > 0, total)
    return j.select(
        *keys,
        "sk1_uuid", *[f"scd1_{a}" for a in attrs], "scd1_last_update",
        "sk2_uuid_current", *[f"scd2_{a}" for a in attrs], "scd2_last_update", "scd2_valid_from",
        total.cast("long").alias("scd2_total_versions"),
        F.least("__p_first", "__c_first", "scd2_valid_from").alias("scd2_first_version"),
        F.greatest("__p_last", "__c_last", "scd2_valid_from").alias("scd2_latest_version"),
        F.when(total > 1, F.lit(True)).otherwise(F.lit(False)).alias("has_history"),
        F.lit(SCD1_BEHAVIOR).alias("scd1_behavior"),
        F.lit(SCD2_BEHAVIOR).alias("scd2_behavior"),
        audit_time(run_ts).alias(GOLD_CREATED_AT),
    )


def version_history(scd2: DataFrame, keys: Sequence[str], *, run_ts=None, ordered: bool = True) -> DataFrame:
    """Every version with ``record_state`` and ``days_valid`` (whole days
    between start and end, NULL while open), ordered by key and start.

    Ordering is a range-partitioned global sort; pass ``ordered=False`` when
    the consumer clusters on write instead (see ``cluster_by_range``).
    """
    keys = list(keys)
    biz = [c for c in scd2.columns if c not in (SILVER_CREATED_AT, SOURCE_SYSTEM)]
    out = scd2.select(
        *biz,
        F.when(F.col(IS_CURRENT), F.lit(STATE_OPEN)).otherwise(F.lit(STATE_CLOSED)).alias("record_state"),
        whole_days(VALID_FROM, VALID_TO).alias("days_valid"),
        F.col(SILVER_CREATED_AT),
        audit_time(run_ts).alias(GOLD_CREATED_AT),
    )
    return out.orderBy(*keys, VALID_FROM) if ordered else out
