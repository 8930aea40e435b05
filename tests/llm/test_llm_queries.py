"""Queries that have SQL against it, and what every entry must have."""

import pytest

import __spark_entry__ as driver
from noticemill.llm import oracles, queries
from tests.conftest import SMALL
from tests.test_queries import sorted_rows

QUERIES, SQL = queries.queries(), oracles.oracle_sql()


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, cursor.fetchall())
