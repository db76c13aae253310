"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from roadlens.catalog import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") else s
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in rec) for rec in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_small, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(entry.oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, duck, name):
    got = entry.queries()[name](spark, sf_small).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["Year", "Month", "accident_count", "month_rank_in_year"]
    assert df.count() == 80
