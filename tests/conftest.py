import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronodim.plans.session import build_session  # noqa: E402

SEED_DDL = ("center_cd string, center_name string, region string, country string, "
            "cost_type string, status string, valid_from string, updated_at string")

# The five seed rows of the cost-centre source and the batch-1 change time.
SEED_ROWS = [
    ("cd001", "Centro Norte", "Norte", "MX", "OPEX", "ACTIVE", "2023-01-01", "2024-01-15 10:00:00"),
    ("cd002", "Centro Sur", "Sur", "MX", "CAPEX", "ACTIVE", "2023-01-01", "2024-01-15 10:00:00"),
    ("cd003", "Centro Este", "Este", "MX", "OPEX", "ACTIVE", "2023-03-01", "2024-02-20 09:30:00"),
    ("cd004", "Centro Oeste", "Oeste", "MX", "CAPEX", "INACTIVE", "2023-06-01", "2024-03-10 14:00:00"),
    ("cd005", "Centro CDMX", "CDMX", "MX", "OPEX", "ACTIVE", "2023-06-01", "2024-03-10 14:00:00"),
]
T_UPDATE = "2025-06-01 09:00:00"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="chronodim-test-")
    s = build_session("local[4]", app_name="chronodim-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g",
                             "spark.sql.maxMetadataStringLength": "2000"})  # else plans are cut, the sooner the longer column ids are
    s.sparkContext.setCheckpointDir(ckpt)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def typed_raw(spark, rows):
    df = spark.createDataFrame(rows, SEED_DDL)
    return df.selectExpr("center_cd", "center_name", "region", "country", "cost_type", "status",
                         "valid_from", "updated_at")


@pytest.fixture()
def raw0(spark):
    return typed_raw(spark, SEED_ROWS)


@pytest.fixture()
def raw1(spark):
    from chronodim.operators.maintenance import patch_rows

    base = typed_raw(spark, SEED_ROWS)
    new = typed_raw(spark, [("cd006", "Centro Bajio", "Bajio", "MX", "OPEX", "ACTIVE", "2025-01-01", T_UPDATE)])
    return patch_rows(base, "center_cd",
                      {"cd003": {"center_name": "Centro Este 2.0", "updated_at": T_UPDATE},
                       "cd004": {"status": "ACTIVE", "updated_at": T_UPDATE}}, new)
