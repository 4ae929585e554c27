"""Every registered query against its SQL, over whole tables."""

import pytest

from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries
from check import compare, connect

OWN = sorted(set(queries()) - set(LLM_QUERIES))


@pytest.fixture(scope="module")
def con(small_tables):
    return connect(small_tables)


def test_every_query_has_sql():
    assert set(OWN) <= set(oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, small_tables, name):
    assert compare(spark, con, name, small_tables) is None


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "recommended_advice" in df.columns
