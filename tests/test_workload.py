"""Every registered query against its SQL counterpart."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from starforge.workload import ORACLE, QUERIES
from tools.check import TABLES, rows

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, answer.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())


def test_star_load_loads_anew_each_time(spark):
    for _ in range(2):
        counts = QUERIES["staged_star_load"](spark, DATA).collect()
        assert all(r["before"] == 0 and r["inserted"] == r["after"] for r in counts)
