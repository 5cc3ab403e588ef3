import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session

    scratch = tempfile.mkdtemp(prefix="strata-test-")
    s = get_session("local[*]", app_name="strata-tests", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    # only where unset, as in tests: a private shared folder for written intermediates
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", f"{scratch}/checkpoints")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from strata.session import scratch_path

    return scratch_path(spark, "test")
