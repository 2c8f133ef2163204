import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gridlake.session import build_session

    warehouse = tempfile.mkdtemp(prefix="gridlake-wh-")
    s = build_session(
        "local[4]",
        app_name="gridlake-tests",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
