"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    from martlet.registry import ORACLE_SQL, QUERIES

    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) > 0
    if key not in E.oracle_sql():
        return
    cur = duck.execute(E.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, rows) == _rows(names, expected)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "ctl_validfrom"
