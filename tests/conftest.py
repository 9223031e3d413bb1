import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillflow.session import get_spark
    s = get_spark("local[4]", app="tillflow-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder below the shared checkpoint dir for one test."""
    from tillflow.session import shared_path
    return shared_path(spark, "test")
