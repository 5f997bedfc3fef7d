"""Every query with oracle SQL must return the same rows as DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry

QUERIES = spark_entry.queries()
ORACLES = spark_entry.oracle_sql()
SPARK_TO_DUCKDB = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{sf_dir}/{file}'")
    return connection


def comparable(rows: list[tuple]) -> list[tuple]:
    def cell(value: object) -> object:
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "NULL"
        return repr(value)

    return sorted(tuple(cell(value) for value in row) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(name, spark, duck, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    oracle_types = {column[0]: str(column[1]) for column in cursor.description}
    spark_types = {column: SPARK_TO_DUCKDB[kind] for column, kind in result.dtypes}
    assert spark_types == oracle_types

    columns = sorted(spark_types)
    positions = [list(oracle_types).index(column) for column in columns]
    expected = [tuple(row[i] for i in positions) for row in cursor.fetchall()]
    actual = [tuple(row) for row in result.select(*columns).collect()]
    assert len(actual) > 0
    assert comparable(actual) == comparable(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert "window_start" in spark_entry.entry(spark).columns
