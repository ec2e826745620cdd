"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import datetime
import os

import duckdb
import pytest

from tidemark import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f[: -len(".parquet")] for f in os.listdir(FOLDER)] if os.path.isdir(FOLDER) else []
queries.load_all()

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def test_every_query_has_an_oracle():
    assert set(queries.BUILDERS) == set(queries.ORACLES)


@pytest.mark.parametrize("name", sorted(queries.BUILDERS))
def test_same_rows(spark, duck, name):
    result = queries.BUILDERS[name](spark, FOLDER)
    expected = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert _rows(result.columns, result.collect()) == _rows(columns, expected.fetchall())
