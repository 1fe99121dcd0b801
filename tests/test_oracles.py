"""Driver-style comparison at sf0.001: Spark query vs DuckDB oracle."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["lineitem", "orders", "customer", "part", "embeddings", "pages"]


def _norm(v):
    if hasattr(v, "tolist") and not isinstance(v, (int, float, str)):
        v = v.tolist()
    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        f = float(v)
        return "NULL" if math.isnan(f) else repr(f)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                        key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 38


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    sp = sdf.toPandas()
    dp = con.execute(E.oracle_sql()[name]).df()
    sc, sr = _rows(sp)
    dc, dr = _rows(dp)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [r["epoch"] for r in sorted(rows, key=lambda r: r["epoch"])] == [0, 1]
    assert df.columns == ["epoch", "eta", "squared_error", "n", "rmse"]
