"""Batch high watermark: skip rows not newer than the target's latest change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronodim.constants import EMPTY_WATERMARK, SOURCE_TS


def high_watermark(state: DataFrame, ts: str = SOURCE_TS, default: str = EMPTY_WATERMARK) -> DataFrame:
    """One row, one column ``watermark``: ``coalesce(max(ts), default)``.

    Partial + final aggregate over a single pruned column.
    """
    t = state.schema[ts].dataType
    return state.agg(F.coalesce(F.max(ts), F.lit(default).cast(t)).alias("watermark"))


def watermark_value(state: DataFrame, ts: str = SOURCE_TS, default: str = EMPTY_WATERMARK) -> Column:
    """The watermark as a scalar subquery, evaluated once per query and
    pushed into the scan of the frame it filters."""
    return high_watermark(state, ts, default).scalar()


def above_watermark(df: DataFrame, state: DataFrame, ts: str = SOURCE_TS,
                    state_ts: str = SOURCE_TS, default: str = EMPTY_WATERMARK) -> DataFrame:
    """Rows of ``df`` strictly newer than the table-wide maximum of ``state``.

    Ties and older rows are skipped whatever their key; a NULL change time
    never passes.
    """
    return df.where(F.col(ts) > watermark_value(state, state_ts, default))


def late_rows(df: DataFrame, state: DataFrame | None, ts: str = SOURCE_TS,
              state_ts: str = SOURCE_TS, default: str = EMPTY_WATERMARK,
              watermark: Column | None = None) -> DataFrame:
    """The complement of :func:`above_watermark`: rows an incremental run
    skips (at or below the watermark, or without a change time).
    ``watermark`` replaces the scan of ``state`` when the value is kept."""
    wm = watermark if watermark is not None else watermark_value(state, state_ts, default)
    return df.where(F.col(ts).isNull() | (F.col(ts) <= wm))
