import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shipped(spark):
    from polidata.llm.queries import ship_package
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="session")
def texts(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()


#: Nulls, empty and blank texts, repeated rows and ids, and columns whose names clash with results.
ODD = [(None, None), (-1, None), (-2, ""), (-3, "  \n "), (-4, "same text here twice"), (-4, "same text here twice"),
       (-5, "other text under one id"), (-5, "é" * 50 + " 中文 \U0001F600 x"), (-6, "word " * 60_000)]


@pytest.fixture(scope="session")
def odd(shipped):
    return shipped.createDataFrame([(i, t, "s", 1.0, 7) for i, t in ODD], "doc_id long, text string, spans string, score double, node int")


@pytest.fixture(scope="session")
def no_docs(shipped):
    return shipped.createDataFrame([], "doc_id long, text string, score double")


@pytest.fixture(scope="session")
def no_labels(shipped):
    return shipped.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd_labels(shipped):
    return shipped.createDataFrame([(-4, 1, 0), (-4, 0, 1), (-5, 0, 1), (-6, None, None), (None, 1, 1), (-2, 1, 0)], "doc_id long, quality int, toxic int")
