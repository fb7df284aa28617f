"""Expressions over half-open validity intervals ``[valid_from, valid_to)``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_time_literal(t: str | dt.datetime | dt.date | Column, like_type: str = "timestamp") -> Column:
    """A time constant typed like the interval columns it is compared to."""
    if isinstance(t, Column):
        return t
    if isinstance(t, (dt.datetime, dt.date)):
        t = t.isoformat(sep=" ") if isinstance(t, dt.datetime) else t.isoformat()
    return F.lit(str(t)).cast(like_type)


def valid_at(valid_from: str, valid_to: str, t: Column) -> Column:
    """``valid_from <= t < valid_to``, an open end (NULL) never expires."""
    return (F.col(valid_from) <= t) & (F.col(valid_to).isNull() | (F.col(valid_to) > t))


def whole_days(start: str, end: str) -> Column:
    """Whole days between two instants from whole epoch seconds, truncated
    toward zero; NULL when ``end`` is NULL (an open interval)."""
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return F.when(F.col(end).isNotNull(), (seconds / F.lit(86400)).cast("int"))


# Blocks of days: level l holds blocks of 2**l days.  An interval lies in the
# smallest block that holds both its ends, so the intervals that contain an
# instant lie in one block a level.
SPAN_LEVELS = 22
SPAN_SHIFT = 1 << 20   # makes day numbers positive
SPAN_STEP = 1 << 32    # between the numbers of two levels


def day_span(start: str, end: str) -> Column:
    """Number of the block of days that holds ``[start, end]``; NULL if an end
    is missing."""
    first, last = (F.unix_date(F.col(c).cast("date")).cast("long") + F.lit(SPAN_SHIFT) for c in (start, end))
    differ = first.bitwiseXOR(last)
    level = F.when(differ == 0, F.lit(0)).otherwise(F.length(F.bin(differ)))
    return level.cast("long") * F.lit(SPAN_STEP) + F.call_function("shiftright", first, level)


def spans_at(t: str | dt.datetime | dt.date) -> list[int]:
    """Numbers of the blocks that can hold an interval containing ``t`` (UTC)."""
    if not isinstance(t, dt.date):
        t = dt.datetime.fromisoformat(str(t))
    if isinstance(t, dt.datetime) and t.tzinfo:
        t = t.astimezone(dt.timezone.utc)
    day = t.toordinal() - dt.date(1970, 1, 1).toordinal() + SPAN_SHIFT
    return [level * SPAN_STEP + (day >> level) for level in range(SPAN_LEVELS)]
