import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from topicforge.session import get_spark
    s = get_spark("local[4]", 8, app_name="topicforge-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_tables():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    return path
