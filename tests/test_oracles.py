"""Every query with SQL text gives the rows that SQL gives."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_registry():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert "op" not in {name.split("_")[0] for name in queries}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, folder, name):
    problem, _ = compare(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name])
    assert problem is None, problem
