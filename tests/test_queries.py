"""Every registered query against its SQL twin."""

import pytest
from compare import difference, duck

import __spark_entry__ as registered

QUERIES = registered.queries()
ORACLES = registered.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, sf_dir, con):
    result = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert difference(result, con, ORACLES[name]) is None
    else:
        assert result.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_results_are_not_trivially_empty(spark, con):
    empty = [name for name, sql in ORACLES.items() if not con.sql(sql).fetchall()]
    assert empty == []
