"""Every registered query against its SQL oracle: names, number of rows, values."""

import collections
import decimal
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as registered

QUERIES, ORACLES = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="session")
def duck(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return collections.Counter(tuple(plain(row[place]) for place in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, spark, folder, duck):
    frame = QUERIES[name](spark, folder)
    got = frame.collect()
    result = duck.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    expected = result.fetchall()
    assert sorted(frame.columns) == sorted(columns)
    assert len(got) == len(expected)
    assert len(got) > 0
    assert bag(frame.columns, got) == bag(columns, expected)


def test_queries_without_an_oracle(spark, folder):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, folder).count() > 0, name


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert registered.entry(spark).count() > 0
