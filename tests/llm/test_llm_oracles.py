"""Queries of the subpackage against their SQL in DuckDB, value by value."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from winnower.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

TABLES = Path("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    duck = duckdb.connect()
    for parquet in TABLES.glob("*.parquet"):
        duck.execute(f"create view {parquet.stem} as select * from '{parquet}'")
    cursor = duck.execute(LLM_ORACLE_SQL[name])
    names = [column[0] for column in cursor.description]
    result = LLM_QUERIES[name](spark, str(TABLES))
    assert sorted(result.columns) == sorted(names)
    rows = [tuple(row) for row in result.select(*names).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, cursor.fetchall()))


def test_every_dealt_operator_is_registered():
    numbers = {name.split("_")[0] for name in LLM_QUERIES}
    assert numbers == {"pipeline"} | {f"op{n}" for n in range(1, 14)}
