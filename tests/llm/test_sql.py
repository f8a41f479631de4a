"""Corpus queries beside their SQL, value by value."""

from __future__ import annotations

import pytest

from tallymill.llm.catalog import ORACLES, QUERIES
from tests.check_oracles import _bag, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small, name):
    df = QUERIES[name](spark, small)
    cursor = connect(small).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = _bag(columns, cursor.fetchall())
    assert want and _bag(df.columns, df.collect()) == want
