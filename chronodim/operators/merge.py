"""Upsert by natural key (MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronodim.plans.session import broadcast_if_small, fits_broadcast


def keyed_outer_join(state: DataFrame, changes: DataFrame, keys: Sequence[str],
                     broadcast_max_rows_: int | None = None, small: bool | None = None,
                     key_partitions: int | None = None) -> DataFrame:
    """``state FULL OUTER JOIN changes USING (keys)`` (columns: keys, state
    columns, change columns; names must not overlap outside the keys).

    When ``changes`` is proven small (rows and measured bytes, see
    ``fits_broadcast``) it is computed without moving the state:
    ``state LEFT JOIN broadcast(changes)`` streams the state once, and the
    change rows whose key is absent from the state are found by a semi join
    of the state's key column against the broadcast keys (its result is at
    most one row per change key, so it is broadcast too).  Otherwise both
    sides shuffle on the key.  ``small`` passes a size decision the caller
    already made; without it (and without a bound to check, which runs a job)
    adaptive execution chooses.  When the
    state is bucketed by the key into ``key_partitions`` buckets, the change
    set is hash-partitioned the same way, so only the change set moves.
    """
    keys = list(keys)
    if small is None and broadcast_max_rows_ is not None:
        small = fits_broadcast(changes, broadcast_max_rows_)
    if not small:
        if key_partitions:
            changes = changes.repartition(key_partitions, *keys)
        return state.join(changes, keys, "full_outer")
    change_keys = F.broadcast(changes.select(*keys))
    known = state.select(*keys).join(change_keys, keys, "left_semi").distinct()
    fresh = changes.join(F.broadcast(known), keys, "left_anti")
    left = state.join(F.broadcast(changes), keys, "left")
    state_cols = [f for f in state.schema.fields if f.name not in keys]
    fresh = fresh.select(*keys, *[F.lit(None).cast(f.dataType).alias(f.name) for f in state_cols],
                         *[c for c in changes.columns if c not in keys])
    return left.unionByName(fresh)


def upsert(state: DataFrame, changes: DataFrame, keys: Sequence[str],
           broadcast_max_rows: int | None = None, small: bool | None = None,
           key_partitions: int | None = None) -> DataFrame:
    """Replace the rows of ``state`` whose key appears in ``changes`` and insert
    the new keys: ``state LEFT ANTI JOIN changes.keys UNION ALL changes``.

    ``changes`` should hold one row per key (see ``latest_per_key``); NULL
    keys never match, as in MERGE.  When the change set is proven small
    (``small``, or by checking ``broadcast_max_rows``), only its key columns are broadcast and
    the state is streamed without a shuffle; otherwise both sides shuffle on
    the key (AQE splits skewed state partitions), or only the change set when
    the state is bucketed into ``key_partitions`` buckets by the key.
    """
    keys = list(keys)
    if small is None and broadcast_max_rows is not None:
        changed_keys = broadcast_if_small(changes.select(*keys), broadcast_max_rows)
    else:
        changed_keys = F.broadcast(changes.select(*keys)) if small else changes.select(*keys)
    if key_partitions and not small:
        changed_keys = changed_keys.repartition(key_partitions, *keys)
    kept = state.join(changed_keys, keys, "left_anti")
    return kept.unionByName(changes.select(*state.columns))
