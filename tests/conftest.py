import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shopsight.session import build_session

    # catalog tables of the tests go to a scratch warehouse, not the checkout
    warehouse = tempfile.mkdtemp(prefix="shopsight-warehouse-")
    s = build_session("local[4]", app="shopsight-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
