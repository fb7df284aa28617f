"""Change feeds cut from the test tables into ordered batches.

A feed is a table read whole, a natural key, a change-time column, and a
batch number per row (the run that receives it).  Batches are plain
filters on that number, so each run's scan prunes by predicate.

* ``EVENTS`` (feed F): ``events`` keyed by ``user_id``, change time ``ts``,
  four batches by week; no late rows.
* ``ORDERS`` (feed L): ``orders`` keyed by ``o_custkey``, change time
  ``o_orderdate`` (ties broken by ``o_orderkey``); four periods, and rows of
  an earlier period whose order key is a multiple of ten arrive one batch
  late, so incremental runs must skip them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "_batch"


@dataclass(frozen=True)
class FeedSpec:
    name: str
    table: str
    keys: tuple[str, ...]
    ts: str
    tiebreak: tuple[str, ...]
    attrs: tuple[str, ...]          # attributes shown side by side in the gold mart
    bounds: tuple[str, ...]         # period boundaries on the change time
    run_times: tuple[str, ...]      # load time of each batch (audit stamp)
    late_every: int = 0             # rows with key % late_every == 0 arrive one batch late

    @property
    def n_batches(self) -> int:
        return len(self.bounds) + 1

    def period(self) -> Column:
        p = None
        for i, b in enumerate(self.bounds):
            cond = F.col(self.ts) < F.lit(b).cast("timestamp_ntz")
            p = F.when(cond, F.lit(i)) if p is None else p.when(cond, F.lit(i))
        return p.otherwise(F.lit(len(self.bounds)))

    def late(self) -> Column:
        return F.coalesce(F.col(self.tiebreak[0]) % F.lit(self.late_every) == 0, F.lit(False))

    def batch(self) -> Column:
        if not self.late_every:
            return self.period()
        late = F.when(self.late(), F.lit(1)).otherwise(F.lit(0))
        return F.least(F.lit(self.n_batches - 1), self.period() + late)

    def in_period(self, p: int) -> Column:
        """``period() == p`` as a range on the change time (pushable)."""
        lo = F.lit(self.bounds[p - 1]).cast("timestamp_ntz") if p > 0 else None
        hi = F.lit(self.bounds[p]).cast("timestamp_ntz") if p < len(self.bounds) else None
        cond = None
        if lo is not None:
            cond = F.col(self.ts) >= lo
        if hi is not None:
            cond = (F.col(self.ts) < hi) if cond is None else cond & (F.col(self.ts) < hi)
        else:  # a row without a change time lies in the last period
            cond = F.col(self.ts).isNull() if cond is None else cond | F.col(self.ts).isNull()
        return cond if self.bounds else F.lit(True)

    def in_batch(self, n: int) -> Column:
        """``batch() == n`` written as time ranges, so the scan of each run
        reads only the row groups (or partitions) of its periods."""
        if not self.late_every:
            return self.in_period(n)
        last = self.n_batches - 1
        cond = self.in_period(n) & ~self.late()
        if n > 0:
            cond = cond | (self.in_period(n - 1) & self.late())
        if n == last:
            cond = cond | (self.in_period(n) & self.late())
        return cond


EVENTS = FeedSpec(
    name="events", table="events", keys=("user_id",), ts="ts", tiebreak=(),
    attrs=("event_type", "value"),
    bounds=("2024-01-08", "2024-01-16", "2024-01-24"),
    run_times=("2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-24 00:00:00", "2024-02-01 00:00:00"),
)

ORDERS = FeedSpec(
    name="orders", table="orders", keys=("o_custkey",), ts="o_orderdate", tiebreak=("o_orderkey",),
    attrs=("o_orderstatus", "o_totalprice"),
    bounds=("1997-01-01", "1999-01-01", "2000-06-01"),
    run_times=("1997-01-01 00:00:00", "1999-01-01 00:00:00", "2000-06-01 00:00:00", "2001-09-01 00:00:00"),
    late_every=10,
)

FEEDS = {f.name: f for f in (EVENTS, ORDERS)}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_feed(spark: SparkSession, sf_dir: str, spec: FeedSpec) -> DataFrame:
    """The feed's table with its batch number in ``_batch``."""
    return read_table(spark, sf_dir, spec.table).withColumn(BATCH, spec.batch())


def feed_batch(feed: DataFrame, n: int, spec: FeedSpec | None = None) -> DataFrame:
    """Raw rows arriving in batch ``n``.  With ``spec`` the filter is the
    pushable time-range form of the batch number."""
    if spec is not None:
        return feed.where(spec.in_batch(n)).drop(BATCH)
    return feed.where(F.col(BATCH) == F.lit(n)).drop(BATCH)
