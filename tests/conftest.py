import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from priceloom.session import build_session
    ckpt = tempfile.mkdtemp(prefix="priceloom-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="priceloom-test-wh-")
    s = build_session("local[4]", shuffle_partitions=4, app_name="priceloom-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture(scope="session")
def small_tables(spark):
    from priceloom.plans.tables import from_testdata
    return from_testdata(spark, SF_SMALL)
