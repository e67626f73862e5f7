import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from casefile.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, app="casefile-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("TESTDATA not present")
    return SF_SMALL
