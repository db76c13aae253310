import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadlens.session import build_session

    session = build_session(master="local[4]", shuffle_partitions=4, app="roadlens-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("scale-factor tables not available")
    return SF_SMALL
