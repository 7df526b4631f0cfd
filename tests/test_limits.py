"""Inputs past former limits, and rows on which helpers used to go wrong."""

import pytest
from pyspark.sql import functions as F

from polidata.functions import text as X
from polidata.operators import aggregates as A
from polidata.operators import joins as J
from polidata.operators import quality as Q
from polidata.sources import readers as R


def test_csv_of_seventy_columns(spark, tmp_path):
    names = [f"k{i}" for i in range(70)]
    cells = [f"v{i}" for i in range(68)] + ['"a, ""b"""', ""]
    (tmp_path / "f.csv").write_text(",".join(names) + "\n" + ",".join(cells) + "\n")
    row = R.read_csv_by_header(spark, str(tmp_path), "^k0,", ["k0", "k67", "k68", "k69"]).first()
    assert (row.k0, row.k67, row.k68, row.k69) == ("v0", "v67", 'a, "b"', None)


def test_fields_that_do_not_fit_raise(spark):
    def record(k):
        parts = [R.fitting(F.col("k"), 5, "0"), F.lit("x")]
        return [r.v for r in spark.createDataFrame([(v,) for v in k], "k long").select(R.fixed_record(parts, 6).alias("v")).collect()]
    assert record([12345, 7, None]) == ["12345x", "00007x", None]
    with pytest.raises(Exception, match="does not fit"):
        record([123456])


def test_links_in_varied_markup(spark):
    page = "<a class=x href='/1'>one\ntwo</a><A HREF = \"/2\">b</A><a href=\"/3\" id=q>c</a><abbr href='/no'>d</abbr>"
    got = spark.createDataFrame([(page,)], "h string").select(R.html_links(F.col("h")).alias("z")).first().z
    assert [(x.href, x.text) for x in got] == [("/1", "one\ntwo"), ("/2", "b"), ("/3", "c")]


def test_second_place(spark):
    df = spark.createDataFrame([("a", 5, None, "x"), ("a", 4, 1, "y"), ("a", 3, 2, "z"), ("b", 1, 1, "q"), ("c", 2, 1, "r"), ("c", 2, 1, "r"), ("d", 2, 2, "s"), ("d", 2, 1, "t")],
                               "k string, v int, t int, n string")
    got = {r.k: (r.n_1, r.n_2) for r in A.top2(df, ["k"], "v", "t", ["n"]).collect()}
    assert got == {"a": ("x", "y"), "b": ("q", None), "c": ("r", "r"), "d": ("t", "s")}


def test_replace_first_with_line_breaks_and_groups(spark):
    df = spark.createDataFrame([("a\nb (x)\nc (y)",)], "v string")
    assert df.select(X.remove_paren(F.col("v"))).first()[0] == "a\nb\nc (y)"
    assert df.select(X.replace_first(F.col("v"), "(b) (.x.)", "-")).first()[0] == "a\n-\nc (y)"


def test_natural_join_matches_nulls(spark):
    a = spark.createDataFrame([(1, "p"), (None, "q")], "k int, x string")
    b = spark.createDataFrame([(1, "r"), (None, "s")], "k int, y string")
    assert sorted(map(tuple, J.natural_join(a, b).collect()), key=str) == sorted([(1, "p", "r"), (None, "q", "s")], key=str)


def test_junk_labels_are_whole_labels(spark):
    names = ["Scattered", " N/A ", "Scatterfield, Ann", "Nullman, NULLA"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(Q.is_junk_label(F.col("n"))).collect()] == [True, True, False, False]
