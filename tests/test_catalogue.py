"""Every query with an oracle against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if v is None or v != v:
        return "NULL"
    return repr(round(v, 8)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    rel = duck.sql(entry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted(tuple(cell(r[c]) for c in cols) for r in df.collect())
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted(tuple(cell(r[i]) for i in at) for r in rel.fetchall())


def test_entry(spark, duck):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
