"""Every registered query against its SQL oracle (DuckDB) at sf0.01."""

import pytest

from tests.conftest import SF001
from tests.oracle import compare, duck

import __spark_entry__ as entry_mod

QUERIES = entry_mod.queries()
SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    n = compare(QUERIES[name](spark, SF001), con, SQL[name])
    assert n >= 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF001).count() >= 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["item_id", "window_end", "cnt", "rn"]
