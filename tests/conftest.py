import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starpipe.session import get_session

    scratch = tempfile.mkdtemp(prefix="starpipe-tests-")
    s = get_session("local[*]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "8g",
    })
    from starpipe.session import scratch_dir
    scratch_dir(s)   # the session's spark.checkpoint.dir, or a temp folder when none is set
    yield s
    s.stop()


@pytest.fixture()
def ts():
    import datetime as dt

    def make(s: str):
        return dt.datetime.fromisoformat(s)
    return make
