"""Years come from the data: rows of any year are kept, here and in the oracle SQL."""

import duckdb
import pytest

import __spark_entry__ as E
from polidata.plans.tables import TABLES
from tests.test_catalog import SF, _digest

QUERIES = ["q_unpivot_years", "q_bea_gsp", "q_bea_income", "q_disposition", "q_plant_registry"]


@pytest.fixture(scope="module")
def moved(tmp_path_factory):
    """The smallest tables with some dates moved to 1987, 1994, 2002 and 2031."""
    folder = tmp_path_factory.mktemp("years")
    con = duckdb.connect()
    change = {"lineitem": ("l_shipdate", "l_orderkey"), "orders": ("o_orderdate", "o_orderkey")}
    for t in TABLES:
        cols = "*"
        if t in change:
            date, key = change[t]
            cols = f"""* REPLACE (CASE {key} % 40 WHEN 0 THEN TIMESTAMP '1987-05-01' WHEN 1 THEN TIMESTAMP '1994-12-31'
                WHEN 2 THEN TIMESTAMP '2002-01-01' WHEN 3 THEN TIMESTAMP '2031-07-04' ELSE {date} END AS {date})"""
        con.execute(f"COPY (SELECT {cols} FROM read_parquet('{SF}/{t}.parquet')) TO '{folder}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return str(folder), con


@pytest.mark.parametrize("name", QUERIES)
def test_rows_of_other_years_are_kept(spark, moved, name):
    folder, con = moved
    df = E.queries()[name](spark, folder)
    cur = con.execute(E.oracle_sql()[name])
    want, cols = cur.fetchall(), [d[0] for d in cur.description]
    got = [tuple(r) for r in df.collect()]
    assert _digest(got, df.columns) == _digest(want, cols)
    if "year" in df.columns:
        assert {1987, 1994, 2002, 2031} <= {r[df.columns.index("year")] for r in got}
