import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from arrivals.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="arrivals-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_root(spark):
    from arrivals.session import scratch_dir
    return scratch_dir(spark, "test")
