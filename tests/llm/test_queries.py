"""Every query of the subpackage on the smallest tables."""

import pytest
from oracle_check import compare, connect

from docmill.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name]) == []
