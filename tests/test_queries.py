"""Every registered query that has SQL agrees with it on the smallest tables."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


entry.catalog.load()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    problems, _ = compare(spark, con, FOLDER, name)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(entry.catalog.QUERIES) - set(entry.oracle_sql())))
def test_runs_without_sql(spark, name):
    """Results that SQL cannot express: the query runs over the whole tables and has rows."""
    assert len(entry.queries()[name](spark, FOLDER).collect()) > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
