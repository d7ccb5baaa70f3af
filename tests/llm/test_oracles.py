"""Queries that SQL can express, against DuckDB."""

import pytest
from compare import compare, duck

from trendlens.llm.queries import ORACLE, QUERIES

SF_ORACLE = "/root/testdata/sf0.01"

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    ok, what = compare(QUERIES[name](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE[name])
    assert ok, what
