"""Every query with SQL must give the same rows as DuckDB on the same tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from strataline.workload.oracle import ORACLE_SQL
from strataline.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    yield con
    con.close()


def canonical(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in entry.oracle_sql()])
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    expected = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(names, expected.fetchall())
    assert got


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_runs(spark):
    assert entry.entry(spark).columns[:2] == ["c_custkey", "season"]
