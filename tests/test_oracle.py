"""Every registered query against its DuckDB oracle (exact, order-insensitive)."""

import os

import duckdb
import pytest

from conftest import SF001
from tools.check_oracle import TABLES, _rows

import __spark_entry__ as entry_mod
from heatgrid.plans import catalog

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 6
