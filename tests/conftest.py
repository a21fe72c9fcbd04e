import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session
    s = build_session("local[*]", app="ledgerlake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def zone(spark):
    from ledgerlake.sources.zone import RawZone
    return RawZone.from_driver(spark, SF_SMALL)


@pytest.fixture()
def tmp_stage(spark):
    from ledgerlake.session import scratch_path
    return scratch_path(spark, "tests")
