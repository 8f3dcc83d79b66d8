import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from leadflow.session import checkpoint_dir, local_session

    s = local_session(8, shuffle_partitions=8, app="leadflow-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from oracle import duck

    return duck(SMALL)


@pytest.fixture(scope="session")
def duck_mid():
    from oracle import duck

    return duck(MID)
