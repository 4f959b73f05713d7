"""Every registered query against its SQL in DuckDB, on the whole tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _comparable(columns: list[str], found: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in found]
    return sorted(plain, key=repr)


def test_every_query_of_the_trip_jobs_has_an_oracle():
    assert {query.__name__ for query in contract.QUERIES} <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = tables.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    found = _comparable(df.columns, [tuple(r) for r in df.collect()])
    assert found
    assert found == _comparable(columns, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).columns == ["pickup_hour", "avg_passenger_count"]
