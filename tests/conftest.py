import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from textguard.session import local_session

    s = local_session(4, 8, app="textguard-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from oracle_check import duck

    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_check():
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from oracle_check import duck

    return duck(SF_CHECK)
