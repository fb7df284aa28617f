"""Quoted CSV read by many tasks equals Spark's reader of whole files."""

import random

import pytest

from chronodim.plans.session import new_run_dir
from chronodim.sources.seed import csv_records, read_csv_seed, read_csv_whole, write_csv_seed

DDL = "k int, v string, w string"


def texts(rng, n):
    bits = ['"', '""', "\n", "\n\n", ",", " ", "a", "bé", "\\", "日本", "x" * 50, "\t"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture()
def small_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for k in keys:
        spark.conf.set(k, "700")
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("files", [1, 3])
def test_equals_the_whole_file_reader(spark, small_blocks, files):
    rng = random.Random(files)
    data = [(i, rng.choice([None, t]), u) for i, (t, u) in enumerate(zip(texts(rng, 300), texts(rng, 300), strict=True))]
    data[7] = (7, "long " * 1000 + '"\n' * 500, "")  # over many blocks
    path = f"{new_run_dir(spark, 'csv')}/csv"
    write_csv_seed(spark.createDataFrame(data, DDL).coalesce(files), path)
    got = read_csv_seed(spark, path, DDL)
    assert csv_records(spark, path).select("file", "block").distinct().count() > 10 * files
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    want = sorted(map(tuple, read_csv_whole(spark, path, DDL).collect()), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want == sorted(data, key=str)


def test_files_without_records(spark):
    path = f"{new_run_dir(spark, 'csv')}/csv"
    write_csv_seed(spark.createDataFrame([], DDL), path)
    assert read_csv_seed(spark, path, DDL).count() == 0


def test_malformed_values_stop_the_read(spark):
    path = f"{new_run_dir(spark, 'csv')}/csv"
    write_csv_seed(spark.createDataFrame([("no number", "a")], "k string, v string"), path)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_seed(spark, path, "k int, v string").collect()
