"""Reads over the dimension tables: current state, history, point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronodim.constants import IS_CURRENT, SK, VALID_FROM, VALID_TO
from chronodim.functions.intervals import as_time_literal, valid_at


def current_versions(scd2: DataFrame) -> DataFrame:
    """Open versions (``is_current = true``); a filter on a partition column
    when the table is stored partitioned by it."""
    return scd2.where(F.col(IS_CURRENT) == F.lit(True))


def as_of_time(scd2: DataFrame, t, key_filter: Column | None = None) -> DataFrame:
    """Versions valid at instant ``t``: ``valid_from <= t < valid_to`` (open
    end never expires).  At most one row per key when intervals are sound.
    Both predicates reach the parquet scan as pushed filters."""
    tcol = as_time_literal(t, scd2.schema[VALID_FROM].dataType.simpleString())
    out = scd2.where(valid_at(VALID_FROM, VALID_TO, tcol))
    return out if key_filter is None else out.where(key_filter)


def report(df: DataFrame, columns: Sequence[str | Column], order_by: Sequence[str]) -> DataFrame:
    """Projection of a table ordered for display."""
    return df.select(*columns).orderBy(*order_by)


def scd1_report(scd1: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    return report(scd1, [F.col(SK).alias("sk_name_scd1"), *keys, *attrs, "_silver_updated_at"], keys)


def scd2_current_report(scd2: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    return report(current_versions(scd2),
                  [F.col(SK).alias("sk_name_scd2_current"), *keys, *attrs, VALID_FROM, IS_CURRENT], keys)


def scd2_versions_report(scd2: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    return report(scd2, [SK, *keys, *attrs, VALID_FROM, VALID_TO, IS_CURRENT], [*keys, VALID_FROM])


def comparison_report(gold: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    return report(gold, [*keys, "sk1_uuid", "sk2_uuid_current", f"scd1_{status}", f"scd2_{status}",
                         "has_history", "scd2_total_versions"], keys)
