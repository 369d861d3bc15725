"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import pytest

import __spark_entry__ as contract
import check


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.database(sf_dir)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, sf_dir, name):
    ok, note = check.compare(spark, con, name, sf_dir)
    assert ok, note


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 7


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
