"""Every registered query against its DuckDB SQL on the sf0.001 tables,
plus the driver entry points."""

import pytest

import __spark_entry__ as ent
from chronodim.plans import registry
from oracle_compare import compare

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "scd2_total_versions" in df.columns


def test_every_query_has_oracle():
    assert set(registry.QUERIES) <= set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)
    assert res[name][0] == "ok", res[name]
