"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from docmill.plans.oracle import ORACLE_SQL
from docmill.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name]) == []


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    total = df.filter("level = 3").collect()
    assert len(total) == 1 and total[0]["outcomes"] == 250
