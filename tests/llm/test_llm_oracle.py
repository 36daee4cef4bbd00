"""Every query of the text operators that has a DuckDB twin, on whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tabvitals.llm.oracle import ORACLE
from tabvitals.llm.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    assert not any(isinstance(v, float) and math.isnan(v) for r in picked for v in r)
    return sorted(columns), sorted(picked, key=lambda r: [(v is None, str(v)) for v in r])


def test_all_are_registered():
    assert set(entry.queries()) >= {*QUERIES, "pipeline"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLE[name])
    expected = _rows([c[0] for c in result.description], result.fetchall())
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert actual == expected
    assert len(actual[1]) > 0
