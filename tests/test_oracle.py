"""Golden layer: every registered query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as E
from compare import compare, duck

SF_ORACLE = "/root/testdata/sf0.01"
ORACLE = E.oracle_sql()
# The training-data queries are tested beside their operators.
NAMES = sorted(set(E.queries()) - set(E.LLM_QUERIES))


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["trending_date", "average_views", "total_views", "video_count", "moving_avg_7d"]
