"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from driver_tables import registry

QUERIES, SQL = registry.QUERIES, registry.SQL


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path("/root/testdata/sf0.001").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in data), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, sf, name):
    frame = QUERIES[name](spark, sf)
    duck.execute(SQL[name])
    expected = table([c[0] for c in duck.description], duck.fetchall())
    assert sorted(frame.columns) == sorted(c[0] for c in duck.description)
    found = table(frame.columns, frame.collect())
    assert found == expected
    assert found


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["person_id", "c_name", "total_ticketed_amount"]
    assert frame.count() == 10
