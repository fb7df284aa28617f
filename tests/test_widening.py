"""Column types that change, and several changes of a key in one run."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodim.operators import schema
from chronodim.operators.checks import scd2_violations
from chronodim.operators.scd import scd2_apply, scd2_fold, scd2_fold_initial, scd2_initial, with_next_change
from chronodim.plans.medallion import DimensionStore
from chronodim.plans.session import new_run_dir


def parse(text):
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize("a,b,both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "decimal(5,2)", "decimal(22,2)"), ("int", "decimal(12,0)", "decimal(12,0)"),
    ("decimal(10,4)", "decimal(8,6)", "decimal(12,6)"), ("float", "double", "double"), ("bigint", "double", "double"), ("decimal(9,2)", "float", "double"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", "timestamp"), ("timestamp_ntz", "timestamp", "timestamp"), ("int", "string", "string"),
    ("date", "string", "string"), ("void", "int", "int"), ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int,b:date>", "struct<a:bigint,b:timestamp>", "struct<a:bigint,b:timestamp>")])
def test_common_type_is_the_same_both_ways(a, b, both):
    a, b = (T.NullType() if t == "void" else parse(t) for t in (a, b))
    assert schema.common_type(a, b) == schema.common_type(b, a) == parse(both)
    assert schema.common_type(schema.common_type(a, b), a) == parse(both)


def test_types_without_a_common_one_are_an_error():
    for a, b in (("int", "date"), ("boolean", "int"), ("array<int>", "int"), ("decimal(38,0)", "decimal(38,10)"), ("struct<a:int>", "struct<b:int>"), ("array<int>", "string")):
        with pytest.raises(ValueError, match="no "):
            schema.common_type(parse(a), parse(b))


def test_evolve_widens_both_sides(spark):
    old = spark.sql("SELECT 'a' k, 1 n, DATE '2024-01-01' d, 'gone' g")
    new = spark.sql("SELECT 'b' k, 3000000000 n, TIMESTAMP_NTZ '2024-01-02 03:00:00' d, 'new' c")
    s, c = schema.evolve(old, new, "sync_all_columns")
    assert s.schema.simpleString() == c.schema.simpleString() == "struct<k:string,n:bigint,d:timestamp_ntz,c:string>"
    assert s.first() == ("a", 1, dt.datetime(2024, 1, 1), None)
    s, c = schema.evolve(old, new, "ignore")
    assert s.schema.simpleString() == c.schema.simpleString() == "struct<k:string,n:bigint,d:timestamp_ntz,g:string>"
    assert c.first() == ("b", 3000000000, dt.datetime(2024, 1, 2, 3), None)


def test_type_2_widens_in_the_pure_form(spark):
    rows = spark.sql("SELECT 'a' k, 1 n, TIMESTAMP_NTZ '2024-01-01 00:00:00' source_updated_at, 'S' _source_system")
    s0 = scd2_apply(rows, None, ["k"])
    s1 = scd2_apply(spark.sql("SELECT 'a' k, 3000000000 n, TIMESTAMP_NTZ '2024-01-02 00:00:00' source_updated_at, 'S' _source_system"), s0, ["k"])
    s2 = scd2_apply(spark.sql("SELECT 'a' k, 2.5 n, TIMESTAMP_NTZ '2024-01-03 00:00:00' source_updated_at, 'S' _source_system"), s1, ["k"])
    assert [(r.n, r.is_current) for r in s2.orderBy("valid_from_sk").collect()] == [(1, False), (3000000000, False), (Decimal("2.5"), True)]


@pytest.mark.parametrize("ranges", [1, 3])
def test_the_store_follows_a_widening_source(spark, ranges):
    st = DimensionStore(spark, new_run_dir(spark, "wide"), ["k"], "t", attrs=["n"], key_ranges=ranges)
    cases = [("1", "DATE '2024-05-01'"), ("3000000000", "DATE '2024-05-01'"), ("CAST(0.5 AS DECIMAL(3,1))", "TIMESTAMP '2024-05-01 06:00:00'"), ("CAST(7 AS TINYINT)", "DATE '2024-05-02'")]
    for i, (n, d) in enumerate(cases):
        keys = ["a", "m", "z"] if i == 0 else ["a"]
        st.apply(spark.sql(" UNION ALL ".join(f"SELECT '{k}' k, {n} n, {d} d, TIMESTAMP_NTZ '2024-01-0{i + 1} 00:00:00' t" for k in keys)))
    for table, name in ((st.bronze(), "bronze"), (st.scd1(), "scd1"), (st.scd2(), "scd2")):
        assert table.schema["n"].dataType == T.DecimalType(21, 1), name
        assert table.schema["d"].dataType == T.TimestampType(), name
    one = dt.datetime(2024, 5, 1)
    assert sorted((r.k, r.n, r.d) for r in st.bronze().collect()) == [("a", 7, dt.datetime(2024, 5, 2)), ("m", 1, one), ("z", 1, one)]
    assert [(r.n, r.d) for r in st.scd2().where("k = 'a'").orderBy("valid_from_sk").collect()] == [
        (1, one), (3000000000, one), (Decimal("0.5"), dt.datetime(2024, 5, 1, 6)), (7, dt.datetime(2024, 5, 2))]
    # the runs before keep the types they had
    assert [st.bronze(v).schema["n"].dataType.simpleString() for v in range(4)] == ["int", "bigint", "decimal(21,1)", "decimal(21,1)"]
    assert sorted((r.k, r.n) for r in st.bronze(1).collect()) == [("a", 3000000000), ("m", 1), ("z", 1)]
    assert st.log().where("_commit_id = 0").count() == 3 and st.gold_history().count() == 6
    assert DimensionStore.open(spark, st.root).gold_comparison().where("k = 'a'").first().scd2_total_versions == 4


def test_a_dropped_column_that_comes_back_starts_empty(spark):
    st = DimensionStore(spark, new_run_dir(spark, "back"), ["k"], "t", key_ranges=2)
    st.apply(spark.sql("SELECT * FROM VALUES ('a', 1, TIMESTAMP_NTZ '2024-01-01 00:00:00'), ('z', 1, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS v(k, n, t)"))
    st.apply(spark.sql("SELECT 'a' k, TIMESTAMP_NTZ '2024-01-02 00:00:00' t"))
    st.apply(spark.sql("SELECT 'a' k, 'text' n, TIMESTAMP_NTZ '2024-01-03 00:00:00' t"))
    assert sorted((r.k, r.n) for r in st.bronze().collect()) == [("a", "text"), ("z", None)]


# ---------------------------------------------------- several changes of a key
def changes(spark, data):
    df = spark.createDataFrame(data, "k string, name string, t string")
    return df.select("k", "name", F.col("t").cast("timestamp_ntz").alias("source_updated_at"), F.lit("S").alias("_source_system"))


DATA = [("a", "1", "2024-01-02 00:00:00"), ("a", "2", "2024-01-02 00:00:01"), ("a", "2", "2024-01-02 05:00:00"), ("a", "3", "2024-03-01 00:00:00"), ("b", "1", "2024-01-05 00:00:00"),
        ("old", "late", "2023-01-01 00:00:00"), ("old", "new", "2024-02-01 00:00:00"), (None, "n", "2024-01-01 00:00:00"), (None, "m", "2024-01-03 00:00:00")]


def chain(df):
    return sorted(((r.k, r.name, str(r.valid_from_sk), r.valid_to and str(r.valid_to), r.is_current) for r in df.collect()), key=str)


@pytest.mark.parametrize("bucket", [1, 3600, 10**9])
def test_every_change_gives_a_version(spark, bucket):
    state = scd2_initial(changes(spark, [("old", "first", "2023-06-01 00:00:00"), ("kept", "x", "2023-01-01 00:00:00")]), ["k"])
    got = scd2_fold(changes(spark, DATA), state, ["k"], bucket_seconds=bucket)
    assert chain(got) == sorted([
        ("a", "1", "2024-01-02 00:00:00", "2024-01-02 00:00:01", False), ("a", "2", "2024-01-02 00:00:01", "2024-01-02 05:00:00", False),
        ("a", "2", "2024-01-02 05:00:00", "2024-03-01 00:00:00", False), ("a", "3", "2024-03-01 00:00:00", None, True), ("b", "1", "2024-01-05 00:00:00", None, True),
        ("old", "first", "2023-06-01 00:00:00", "2024-02-01 00:00:00", False), ("old", "new", "2024-02-01 00:00:00", None, True), ("kept", "x", "2023-01-01 00:00:00", None, True),
        (None, "n", "2024-01-01 00:00:00", "2024-01-03 00:00:00", False), (None, "m", "2024-01-03 00:00:00", None, True)], key=str)
    assert scd2_violations(got.where("k is not null"), ["k"]).count() == 0
    assert chain(scd2_fold_initial(changes(spark, DATA), ["k"], bucket_seconds=bucket)) == chain(scd2_fold(changes(spark, DATA), state.limit(0), ["k"], bucket_seconds=bucket))


def test_unchanged_neighbours_can_go(spark):
    got = scd2_fold_initial(changes(spark, DATA[:4]), ["k"], drop_unchanged=True, bucket_seconds=86400)
    assert [(r[1], r[3]) for r in chain(got)] == [("1", "2024-01-02 00:00:01"), ("2", "2024-03-01 00:00:00"), ("3", None)]


def test_a_hot_key_is_split_by_time(spark):
    df = spark.range(20_000).select(F.substring(F.concat(F.lit("hot"), F.col("id").cast("string")), 1, 3).alias("k"), F.lit("x").alias("name"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("source_updated_at"))
    out = with_next_change(df, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "__hour" in plan.split("hashpartitioning(k")[1][:40]
    bad = out.where(~F.col("__next").eqNullSafe(F.col("source_updated_at") + F.expr("INTERVAL 1 MINUTE")))
    assert bad.count() == 1  # the last one


def test_the_store_keeps_every_change(spark):
    st = DimensionStore(spark, new_run_dir(spark, "all"), ["k"], "t", on_duplicate="all", attrs=["name"], key_ranges=2)

    def batch(data):
        return spark.createDataFrame(data, "k string, name string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))

    st.apply(batch([("a", "1", "2024-01-01"), ("a", "2", "2024-01-02"), ("a", "3", "2024-01-03"), ("z", "1", "2024-01-01")]))
    st.apply(batch([("a", "4", "2024-01-04"), ("a", "4b", "2024-01-05"), ("z", "late", "2024-01-02"), ("n", "1", "2024-01-04"), ("n", "1", "2024-01-04")]))
    v = [(r.k, r.name, r.is_current) for r in st.scd2().orderBy("k", "valid_from_sk").collect()]
    assert v == [("a", "1", False), ("a", "2", False), ("a", "3", False), ("a", "4", False), ("a", "4b", True), ("n", "1", True), ("z", "1", True)]
    assert sorted((r.k, r.name) for r in st.bronze().collect()) == [("a", "4b"), ("n", "1"), ("z", "1")]
    assert sorted((r.k, r.name) for r in st.bronze(0).collect()) == [("a", "3"), ("z", "1")]
    assert {r.k: r.scd2_total_versions for r in st.gold_comparison().collect()} == {"a": 5, "n": 1, "z": 1}
    assert st.gold_history().count() == 7 and scd2_violations(st.scd2(), ["k"]).count() == 0
    assert sorted((r.k, r.name) for r in st.scd2(0).where("is_current").collect()) == [("a", "3"), ("z", "1")]
