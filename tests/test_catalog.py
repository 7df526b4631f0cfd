"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from polidata.plans import catalog
from polidata.plans.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(hashlib.md5("|".join(_norm(r[i]) for i in order).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "region", "assembly", "co2", "value", "r"]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, sdf.columns) == _digest(drows, dcols)
