"""Every query against its DuckDB twin, on whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.inputs import TABLES
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _key(row):
    return [(v is None, str(type(v)) if v is None else "", str(v)) for v in row]


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    assert not any(isinstance(v, float) and math.isnan(v) for r in picked for v in r)
    return sorted(columns), sorted(picked, key=_key)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    result = duck.execute(entry.oracle_sql()[name])
    expected = _rows([c[0] for c in result.description], result.fetchall())
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert actual == expected
    assert len(actual[1]) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
