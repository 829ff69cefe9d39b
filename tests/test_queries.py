"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tests.oracle import compare

SQL = E.oracle_sql()
Q = E.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    n = compare(spark, Q[name], SQL[name], SF_ORACLE)
    assert n > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "text", "count"]
