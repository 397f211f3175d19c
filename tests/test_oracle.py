"""Every registered query with an oracle equals DuckDB on the same tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL

from skewkit.plans import retail, scale

NAMES = sorted(retail.SQL | scale.SQL)
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(t):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = duck.sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    idx = [res.columns.index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert len(got) == len(want)
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["product_id", "category", "flag", "total_amount", "n_sales", "avg_quantity"]
    assert df.count() > 0
