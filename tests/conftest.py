import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wayfarer.session import build_session
    s = build_session(master="local[8]", app="wayfarer-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_source(spark):
    from wayfarer.plans.model import source_for
    return source_for(spark, SMOKE)


@pytest.fixture(scope="session")
def source(spark):
    from wayfarer.plans.model import source_for
    return source_for(spark, SF001)
