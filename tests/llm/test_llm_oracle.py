"""Registered llm queries with SQL against DuckDB on the same tables."""

import pytest
from conftest import SF_CHECK
from oracle import compare, duck

from topicscope.llm.oracle import ORACLE_SQL
from topicscope.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_sql_belongs_to_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_CHECK), con, ORACLE_SQL[name])
    assert res["cols_match"], res
    assert res["spark_rows"] == res["duck_rows"] > 0, res
    assert res["values_match"], res
