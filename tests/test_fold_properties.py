"""Property: folding runs over ordered batches equals the direct window
construction (accepted rows -> latest per key and batch -> lead), and the
resulting version chains are sound."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronodim.operators.checks import scd2_violations
from chronodim.operators.gold import compare_dimensions
from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import new_run_dir

BASE = dt.datetime(2024, 1, 1)

events = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 40), st.integers(0, 3), st.text(max_size=3)),
    min_size=1, max_size=25)


def expected(evts):
    """Direct construction in plain Python (batches in order)."""
    wm = None
    versions = []  # (key, t)
    for b in range(4):
        rows = [e for e in evts if e[2] == b]
        acc = [e for e in rows if wm is None or e[1] > wm]
        latest = {}
        for k, t, _, name in acc:
            if k not in latest or (t, name) > (latest[k][0], latest[k][1]):
                latest[k] = (t, name)
        versions += [(k, t) for k, (t, _) in latest.items()]
        if acc:
            wm = max([t for _, t, _, _ in acc] + ([wm] if wm is not None else []))
    out = set()
    for k, t in versions:
        later = sorted(x for kk, x in versions if kk == k and x > t)
        out.add((k, t, later[0] if later else None))
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events)
def test_fold_equals_window(spark, evts):
    df = spark.createDataFrame([(k, BASE + dt.timedelta(minutes=t), b, n) for k, t, b, n in evts],
                               "k string, t timestamp_ntz, b int, name string")
    store = DimensionStore(spark, new_run_dir(spark, "prop"), ["k"], "t")
    for b in range(4):
        store.apply(df.where(f"b = {b}").drop("b"), f"2024-02-0{b + 1} 00:00:00")
    got = {(r.k, int((r.valid_from_sk - BASE).total_seconds() // 60),
            None if r.valid_to is None else int((r.valid_to - BASE).total_seconds() // 60))
           for r in store.scd2().collect()}
    assert got == expected(evts)
    assert scd2_violations(store.scd2(), ["k"]).count() == 0
    # the comparison mart refreshed run by run equals a full rebuild
    full = compare_dimensions(store.scd1(), store.scd2(), ["k"], [])
    cols = [c for c in full.columns if c not in ("_gold_created_at", "sk1_uuid")]
    assert sorted(store.gold_comparison().select(cols).collect()) == sorted(full.select(cols).collect())
    # bronze holds the latest version per key
    cur = {(r.k, r.source_updated_at) for r in store.bronze().collect()}
    assert cur == {(r.k, r.valid_from_sk) for r in store.scd2().where("is_current").collect()}
