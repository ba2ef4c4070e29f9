"""Every registered query against its DuckDB oracle on the smallest data set."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from claimscope.sources.adapters import TABLES

SMALL = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_an_id():
    assert len(QUERIES) >= 100
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_names)
    assert _rows(df.columns, s_rows) == _rows(d_names, d_rows)


def test_entry_smoke(spark):
    out = entry.entry(spark)
    rows = out.collect()
    assert 0 < len(rows) <= 10
    assert "high_acuity_oe_ratio" in out.columns
