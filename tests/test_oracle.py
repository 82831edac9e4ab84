"""Every registered query against its SQL oracle (DuckDB) on the same tables."""

import pytest

from conftest import SF_CHECK
from oracle import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from topicscope.plans import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(queries()[name](spark, SF_CHECK), con, oracle_sql()[name])
    assert res["cols_match"], res
    assert res["spark_rows"] == res["duck_rows"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["day", "topic", "count"]
    assert df.count() > 0
