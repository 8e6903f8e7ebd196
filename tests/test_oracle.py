"""Every query with a SQL twin gives the same rows in Spark and DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from profila.sources.tables import TABLES

from conftest import SF_SMALL

ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    rel = con.sql(ORACLE[name])
    want = _rows(rel.fetchall(), rel.columns)
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "device_id" in df.columns and "top10_app_cnt" in df.columns
