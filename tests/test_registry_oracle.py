"""Every registered query against its DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from ledgerlake import registry
from ledgerlake.plans import ingest_queries
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
SLOW = {"incremental_file_load"}     # covered by tests/test_streaming.py


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_reporting_query_has_an_oracle():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert {*registry.QUERIES, *ingest_queries.QUERIES} <= set(se.oracle_sql())


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "TotalRevenue" in df.columns


@pytest.mark.parametrize("name", sorted(n for n in se.oracle_sql() if n not in SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
