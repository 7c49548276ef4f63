import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[*]", app="strata-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from strata.session import scratch_path
    return scratch_path(spark, request.node.name.replace("[", "_").replace("]", "_"))
