"""Every registered query against its SQL, run by another engine on the same files."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.queries import QUERIES

DATA = Path(os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    frame = queries()[name](spark, str(DATA))
    expected = duck.sql(oracle_sql()[name])
    assert {n: TYPES[t] for n, t in frame.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    mine = comparable([tuple(r) for r in frame.collect()], frame.columns)
    assert mine == comparable(expected.fetchall(), expected.columns)
