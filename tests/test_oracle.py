"""Every registered query against its DuckDB oracle (sf0.001 here; the
driver runs the same pairs at sf0.01)."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from logengine.plans.catalog import QUERIES
from logengine.sources.tables import TABLES, table_path

from .conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = table_path(SF_SMALL, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(se.oracle_sql())
    assert not missing, missing


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["tick", "line"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(se.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=_key)
    cur = duck.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == sorted(df.columns)
    idx = [ocols.index(c) for c in df.columns]
    orows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=_key)
    assert len(rows) == len(orows)
    assert rows == orows
