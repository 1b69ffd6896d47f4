import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = os.environ.get("PROBSCOPE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from probscope.session import local_session
    s = local_session("*", shuffle_partitions=8, app="probscope-tests")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    from probscope.sources.fixtures import load_tables
    return load_tables(spark, sf_dir)
