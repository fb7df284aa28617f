"""Structured Streaming front end: each micro-batch of a change stream is
one run of a :class:`DimensionStore` (``foreachBatch``).

Micro-batch boundaries are arbitrary, so a row is late only against its own
key's change time, never against the table's (``late="key"``).

Exactly-once effect: Spark records progress in the checkpoint (on the
shared folder); a micro-batch replayed after a failure finds all its rows not
newer than their keys, so re-applying it changes nothing, and a batch id
already applied in this process is skipped outright.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import new_run_dir


def _make_sink(store: DimensionStore, build_gold: bool):
    applied: set[int] = set()

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch_id in applied:
            return
        store.apply(batch, build_gold=build_gold, late="key")
        applied.add(batch_id)

    return sink


def start_dimension_stream(changes: DataFrame, store: DimensionStore, *, checkpoint: str | None = None,
                           available_now: bool = False, processing_time: str | None = None,
                           build_gold: bool = True, query_name: str | None = None) -> StreamingQuery:
    """Start a streaming query that applies every micro-batch of the
    streaming DataFrame ``changes`` (raw rows) to ``store``."""
    spark = changes.sparkSession
    w = changes.writeStream.foreachBatch(_make_sink(store, build_gold))
    w = w.option("checkpointLocation", checkpoint or new_run_dir(spark, "stream-checkpoint"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if query_name:
        w = w.queryName(query_name)
    return w.start()
