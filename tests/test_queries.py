"""Every query against its SQL."""

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry
from webstrata.plans.page_queries import QUERIES
from webstrata.plans.page_queries_sql import ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) is None


def test_each_query_has_sql():
    """Of those for the crawl; some of the optional part have no SQL and are tested there."""
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 50 and "charset" in df.columns
