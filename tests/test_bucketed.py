"""Type 2 over a bucketed state table: a large change set shuffles only the
change side."""

from chronodim.operators.scd import scd2_apply_open
from chronodim.plans import registry
from chronodim.sources.feeds import EVENTS

SF = "/root/testdata/sf0.001"


def test_large_change_set_shuffles_only_changes(spark):
    st = registry.build(spark, SF, EVENTS)
    spark.sql("DROP TABLE IF EXISTS bucketed_state")
    st.scd2_current(2).write.bucketBy(4, *EVENTS.keys).sortBy(*EVENTS.keys).saveAsTable("bucketed_state")
    delta = st.log().where("_commit_id = 3").drop("_commit_id", "_committed_at", "_operation")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scd2_apply_open(delta, spark.table("bucketed_state"), EVENTS.keys, changes_small=False, key_partitions=4)
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
    scan = next(i for i, ln in enumerate(lines) if "Bucketed: true" in ln)
    # state side: join -> (sort/project) -> bucketed scan, no exchange in between
    assert not any("Exchange" in ln for ln in lines[join:scan])
    # change side: reduced map-side, then laid out in the 4 buckets
    assert any("Exchange hashpartitioning(user_id" in ln and ", 4)" in ln for ln in lines[scan:])
    spark.sql("DROP TABLE bucketed_state")
