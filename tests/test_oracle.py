"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from rejoinder.plans import catalog
from tests.conftest import TESTDATA

SF_DIR = os.environ.get("ORACLE_SF_DIR", f"{TESTDATA}/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def ordered(found):
    return sorted(found, key=lambda row: [(v is not None, str(v)) for v in row])


def test_every_query_of_the_job_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    relation = duck.sql(contract.oracle_sql()[name])
    columns = sorted(relation.columns)
    assert sorted(df.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    found = ordered(tuple(r[c] for c in columns) for r in df.collect())
    places = [relation.columns.index(c) for c in columns]
    expected = ordered(tuple(r[i] for i in places) for r in relation.fetchall())
    assert len(found) == len(expected) > 0
    for mine, theirs in zip(found, expected):
        assert all(
            a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b)) for a, b in zip(mine, theirs)
        ), (mine, theirs)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["Order ID", "Customer ID", "Order Date", "Return Reason", "Return Date"]
    assert df.count() > 1500
