"""Every registered query against its DuckDB oracle on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from reportflow.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"


def norm(v):
    if v is None:
        return "\0"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "values_text" in df.columns


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    oracle = E.oracle_sql().get(name)
    rows = df.collect()
    if oracle is None:
        return
    cur = duck.execute(oracle)
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    si = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    di = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted(tuple(norm(r[i]) for i in si) for r in rows)
    b = sorted(tuple(norm(r[i]) for i in di) for r in cur.fetchall())
    assert len(a) == len(b)
    assert a == b
