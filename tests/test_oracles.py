"""Every registered query against its SQL, on whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from rowtide.plans.oracles import ORACLES
from rowtide.plans.registry import QUERIES

TESTDATA = "/root/testdata"
SF = os.environ.get("TEST_SF", "sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{TESTDATA}/{SF}/{table}.parquet'")
    return connection


def _normal(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(round(value, 6)))
    return (1, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_normal(row[i]) for i in order) for row in rows)


def test_every_table_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 26


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, f"{TESTDATA}/{SF}")
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(df.columns)
    want = _rows(columns, expected.fetchall())
    got = _rows(df.columns, df.collect())
    assert len(want) > 0
    assert got == want
