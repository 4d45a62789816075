"""Every registered query against its DuckDB SQL twin on the smallest tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as E
from supplyscope.plans import catalog

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


OWN = sorted(catalog.queries())          # optional queries bring their own tests


def test_every_query_has_sql():
    assert set(OWN) <= set(E.queries()) and set(OWN) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    srows = df.collect()
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    s = sorted((tuple(_norm(r[c]) for c in order) for r in srows), key=repr)
    o = sorted((tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows), key=repr)
    assert s == o


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "alerta" in df.columns
