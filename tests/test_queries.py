"""Every registered query gives the rows of its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import check, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    ok, message, _ = check(spark, con, name, queries()[name], oracle_sql().get(name), sf_dir)
    assert ok, message


def test_entry_has_rows_and_a_stable_schema(spark):
    frame = entry(spark)
    assert frame.columns == entry(spark).columns
    assert not frame.isEmpty()


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
