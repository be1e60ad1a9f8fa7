"""Every registered query equals its SQL oracle (DuckDB) on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sojourn.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.harness import compare, duck

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_of_the_toolkit_has_an_oracle():
    assert set(QUERIES) <= set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(queries()[name](spark, SF_SMALL), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["id", "stime", "site", "etime"]
    assert df.count() > 0
