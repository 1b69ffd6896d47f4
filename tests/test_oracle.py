"""Every registered query against its DuckDB oracle (same check as the driver's gate)."""

import pytest

from probscope.plans.oracle import oracle_sql
from probscope.plans.registry import queries
from tests.verify import compare, duck

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    missing = sorted(set(NAMES) - set(oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    res = compare(spark, name, sf_dir, con)
    assert res["ok"], res
