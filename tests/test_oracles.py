"""Every query with SQL equals DuckDB on the smallest tables."""

import pytest

from tallymill.plans.catalog import ORACLES, QUERIES
from tests.check_oracles import compare, connect


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 80


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, small, name):
    assert compare(spark, con, small, name) == ""
