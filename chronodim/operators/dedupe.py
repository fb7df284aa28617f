"""Latest row per natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_by`` tuple.

    Ties on ``order_by`` are broken by a hash of the other columns (map
    columns aside), so the result is deterministic.  NULLs order first, so a
    row with a NULL change time only wins when every row of its key has one.

    Built as ``max_by(row, order)`` per key: the aggregate runs partially on
    the map side, so a key holding a large share of the rows is reduced to
    one row per input partition before the shuffle (no window over a whole
    hot group in one task).  Only the order columns are compared.
    """
    keys = list(keys)
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    hashable = [c for c in rest if "map<" not in df.schema[c].dataType.simpleString()]
    order = F.struct(*[F.col(c) for c in order_by], F.xxhash64(*hashable) if hashable else F.lit(0))
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    out = df.groupBy(*keys).agg(F.max_by(packed, order).alias("_latest"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_latest.{c}").alias(c) for c in order_by + rest]).select(
        *df.columns
    )
