import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = os.environ.get("FOLIO_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from foliospark.session import session

    return session("tests", master="local[4]", shuffle_partitions=4)


@pytest.fixture(scope="session")
def small():
    return SMALL
