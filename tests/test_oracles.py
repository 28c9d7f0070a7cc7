"""Every registered query against its SQL in DuckDB, value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from winnower.oracles import ORACLE_SQL
from winnower.queries import QUERIES

TABLES = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for parquet in TABLES.glob("*.parquet"):
        connection.execute(f"create view {parquet.stem} as select * from '{parquet}'")
    yield connection
    connection.close()


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "null" if value is None else str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = contract.queries()[name](spark, str(TABLES))
    cursor = duck.execute(contract.oracle_sql()[name])
    expected_names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    assert sorted(result.columns) == sorted(expected_names)
    actual = [tuple(row) for row in result.collect()]
    assert len(actual) == len(expected)
    assert _sorted_rows(result.columns, actual) == _sorted_rows(expected_names, expected)


def test_flagship_smoke(spark):
    assert contract.entry(spark).count() == 35
