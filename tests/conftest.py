import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gridspark.session import local_session

    s = local_session("*", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A new folder under the shared folder for each test."""
    from gridspark.session import scratch_path

    return scratch_path(spark, "test")
