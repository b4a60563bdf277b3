"""Registered queries against their DuckDB oracles at sf0.001 (driver contract)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from pitchspark.plans.oracle import ORACLE_SQL

from conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return c


FAST = [q for q in ORACLE_SQL if q not in ("train_evaluate", "grid_search", "importance")]


@pytest.mark.parametrize("name", FAST)
def test_parity(spark, con, name):
    sdf = E.queries()[name](spark, SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert srows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["country", "top_value_sum", "log_squad_value"]
