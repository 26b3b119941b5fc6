import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sentimart.session import build_session

    s = build_session("local[4]", app_name="sentimart-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def nothing_stays_cached(request):
    """A table cached by one test would stand in the plans that later tests look at."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()
