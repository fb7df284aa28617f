"""Key ranges: cut by size, found by binary search, written in sized tasks,
replaced one by one."""

import glob

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from chronodim.operators import ranges
from chronodim.operators.checks import file_overlaps
from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import new_run_dir


def table(spark, n=20_000):
    return spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.repeat(F.col("id").cast("string"), 20).alias("v"))


def in_ranges(df, bounds):
    return df.withColumn(ranges.RANGE, ranges.range_of(bounds, ["k"], df.schema).cast(IntegerType()))


def test_ranges_follow_the_bytes_and_hold_ordered_keys(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_BYTES", 100_000)
    df = table(spark)
    bounds = ranges.cut_bounds(df, ["k"], 1_000_000)
    assert len(bounds) == 9
    got = in_ranges(df, bounds).groupBy("_range").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("n")).orderBy("_range").collect()
    assert [r._range for r in got] == list(range(10)) and sum(r.n for r in got) == 20_000
    assert all(a.hi < b.lo for a, b in zip(got, got[1:], strict=False))
    assert max(r.n for r in got) < 2 * min(r.n for r in got)
    assert ranges.cut_bounds(df, ["k"], 50_000) == []


def test_binary_search_equals_counting_bounds(spark):
    df = spark.createDataFrame([(a, b) for a in (None, "", "a", "b", "ba", "z") for b in (None, -3, 0, 5)], "a string, b int")
    bounds = [["a", "0"], ["b", "-1"], ["b", "5"], ["c", "0"]]
    key = F.struct("a", "b")
    counted = sum(((key >= F.struct(F.lit(x).alias("a"), F.lit(y).cast("int").alias("b"))).cast("int") for x, y in bounds), F.lit(0))
    assert df.select((ranges.range_of(bounds, ["a", "b"], df.schema) == counted).alias("same")).distinct().collect() == [(True,)]


def test_an_oversized_range_is_written_by_several_tasks(spark, monkeypatch):
    path = new_run_dir(spark, "sized")
    monkeypatch.setattr(ranges, "TASK_BYTES", 200_000)
    df = in_ranges(table(spark), [["5000"]])  # ranges of 5,000 and 15,000 rows
    plan = ranges.sized(df, ["_range", "k"], 1_600_000)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(_range" in plan and ", 8)" in plan
    ranges.overwrite_ranges(df, path, ["k"], 1_600_000)
    files = {r: len(glob.glob(f"{path.replace('file:', '')}/_range={r}/*.parquet")) for r in (0, 1)}
    assert files[0] >= 2 and files[1] >= 5
    back = ranges.read_ranges(spark, path, df.schema)
    assert file_overlaps(back, ["k"]).first() == (20_000, 0)
    per_file = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert max(per_file) < 4000  # an eighth of the rows and some


def test_a_small_write_leaves_the_work_before_it_in_its_own_tasks(spark):
    df = table(spark).groupBy("k").agg(F.max("k").alias("v"))
    p = ranges.sized(df, ["k"], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" in p and "Coalesce" not in p
    assert ranges.sized(df, ["k"], 1000).rdd.getNumPartitions() == 1


def test_only_ranges_with_rows_are_replaced(spark):
    path = new_run_dir(spark, "replace")
    df = in_ranges(table(spark, 900), [["300"], ["600"]])
    ranges.overwrite_ranges(df, path, ["k"], 1)
    mine = ranges.read_ranges(spark, path, df.schema, [1])
    assert mine.count() == 300
    # the new rows are read from the range that they replace
    ranges.overwrite_ranges(mine.where("k < 310").withColumn("v", F.lit("new")), path, ["k"], 1)
    back = ranges.read_ranges(spark, path, df.schema)
    assert back.count() == 610 and back.where("v = 'new'").count() == 10
    ranges.overwrite_ranges(back.where("k < 0"), path, ["k"], 1)  # no rows: nothing is replaced
    assert ranges.read_ranges(spark, path, df.schema).count() == 610
    assert ranges.file_bytes(back) > ranges.file_bytes(ranges.read_ranges(spark, path, df.schema, [1])) > 0


def rows(spark, data):
    return spark.createDataFrame(data, "k string, name string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))


def test_a_run_that_failed_half_way_is_repeated(spark, monkeypatch):
    first = [(f"k{i:02d}", "x", "2024-01-01") for i in range(40)]
    second = [("k03", "y", "2024-01-02"), ("k39", "y", "2024-01-02"), ("new", "y", "2024-01-02")]
    cols = ["sk_name", "k", "name", "valid_from_sk", "valid_to", "is_current"]

    def read(st):
        return [sorted(map(tuple, st.scd2(v).select(cols).collect()), key=str) for v in range(st.version + 1)], sorted(map(tuple, st.bronze().select("k", "name").collect()))

    sound = DimensionStore(spark, new_run_dir(spark, "sound"), ["k"], "t", key_ranges=4)
    broken = DimensionStore(spark, new_run_dir(spark, "broken"), ["k"], "t", key_ranges=4)
    for st in (sound, broken):
        st.apply(rows(spark, first))
    sound.apply(rows(spark, second))
    for stop in ("bronze", "scd1"):  # after the open versions were replaced, then after bronze was
        whole = DimensionStore._replace

        def fail(self, df, name, run, size, whole=whole, stop=stop):
            if name == stop:
                raise RuntimeError("lost")
            whole(self, df, name, run, size)

        monkeypatch.setattr(DimensionStore, "_replace", fail)
        try:
            broken.apply(rows(spark, second))
        except RuntimeError:
            pass
        monkeypatch.setattr(DimensionStore, "_replace", whole)
        broken = DimensionStore.open(spark, broken.root)
        assert broken.version == 0
    broken.apply(rows(spark, second))
    assert read(broken) == read(sound)
    assert broken.scd1().select("sk_name").distinct().count() == 41


def scanned(df):
    """Rows that the file scans of ``df`` gave when it ran."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(p):
        if p.nodeName().startswith("Scan") and p.metrics().contains("numOutputRows"):
            found.append(p.metrics().apply("numOutputRows").value())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    walk(plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan)
    return sum(found)


def test_a_lookup_skips_row_groups_without_the_key(spark):
    base = new_run_dir(spark, "bloom")
    df = spark.range(0, 60_000, 1, 3).select((F.col("id") * 7919 % 120_011).alias("k"), F.lit("x").alias("v"))  # every group spans all keys
    ranges.key_filters(df.write.option("parquet.block.size", 65536), ["k"]).parquet(f"{base}/with")
    df.write.option("parquet.block.size", 65536).parquet(f"{base}/without")
    key = df.where("id = 31000").first().k if "id" in df.columns else 31_000 * 7919 % 120_011
    read = {n: scanned(spark.read.parquet(f"{base}/{n}").where(F.col("k") == key)) for n in ("with", "without")}
    assert 0 < read["with"] <= read["without"] / 2, read
    sizes = {n: ranges.file_bytes(spark.read.parquet(f"{base}/{n}")) for n in read}
    assert sizes["with"] < 2 * sizes["without"] + 500_000


def test_history_in_order_without_sampling(spark):
    st = DimensionStore(spark, new_run_dir(spark, "order"), ["k"], "t", key_ranges=4)
    for day in (1, 2, 3):
        st.apply(rows(spark, [(f"k{i:02d}", str(day), f"2024-01-0{day}") for i in range(0, 40, day)]))
    h = st.gold_history()
    assert "rangepartitioning" not in h._jdf.queryExecution().executedPlan().toString()
    got = [(r.k, r.valid_from_sk) for r in h.collect()]
    assert len(got) == 40 + 20 + 14 and got == sorted(got)
