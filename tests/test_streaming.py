"""A file stream of change batches builds the same dimension as batch runs."""

from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import new_run_dir
from chronodim.sources.feeds import EVENTS, feed_batch, read_feed
from chronodim.streaming.micro_batch import start_dimension_stream

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_runs(spark):
    feed = read_feed(spark, SF, EVENTS)
    landing = new_run_dir(spark, "landing")
    for n in range(EVENTS.n_batches):
        feed_batch(feed, n, EVENTS).coalesce(1).write.parquet(f"{landing}/batch={n:03d}")
    schema = spark.read.parquet(f"{SF}/events.parquet").schema

    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(landing))
    streamed = DimensionStore(spark, new_run_dir(spark, "streamed"), EVENTS.keys, EVENTS.ts, attrs=EVENTS.attrs)
    q = start_dimension_stream(stream, streamed, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None

    batched = DimensionStore(spark, new_run_dir(spark, "batched"), EVENTS.keys, EVENTS.ts, attrs=EVENTS.attrs)
    for n in range(EVENTS.n_batches):
        batched.apply(feed_batch(feed, n, EVENTS))

    cols = ["sk_name", "user_id", "event_type", "value", "valid_from_sk", "valid_to", "is_current"]
    assert streamed.version == EVENTS.n_batches - 1
    assert sorted(streamed.scd2().select(cols).collect()) == sorted(batched.scd2().select(cols).collect())
