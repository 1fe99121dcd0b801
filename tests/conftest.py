import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from latentgrid.session import build_session
    s = build_session(master="local[8]", app="latentgrid-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from latentgrid.session import scratch_path
    return scratch_path(spark, "test")


def data(name: str) -> str:
    return os.path.join(DATA, name)
