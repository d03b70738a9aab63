"""Queries of the subpackage against their SQL, on whole tables."""

import os

import duckdb
import pytest

from rowtide.llm.queries import ORACLES, QUERIES

SF = f"/root/testdata/{os.environ.get('TEST_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations", "benchmark", "labels"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(df.columns)
    got = _rows(df.columns, df.collect())
    assert got and got == _rows(columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
