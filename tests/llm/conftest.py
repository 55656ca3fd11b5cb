import os

import pytest


@pytest.fixture(scope="session")
def small():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    return path
