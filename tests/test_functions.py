import datetime as dt

from pyspark.sql import functions as F

from polidata.functions import civics as C
from polidata.functions import dates as D
from polidata.functions import text as X
from polidata.functions.nullsafe import if_else, row_sum, split_part, str_c, strict_avg, strict_sum, sum_na_zero


def test_strict_and_na_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0), ("c", None)], "k string, v double")
    out = {r.k: r for r in df.groupBy("k").agg(strict_avg("v").alias("m"), F.avg("v").alias("m2"),
                                                sum_na_zero("v").alias("s0"), strict_sum("v").alias("ss")).collect()}
    assert out["a"].m is None and out["a"].m2 == 1.0
    assert out["b"].m == 3.0 and out["b"].ss == 6.0
    assert out["c"].s0 == 0 and out["c"].ss is None


def test_if_else_null_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (20,)], "x int")
    got = [r.y for r in df.select(if_else(F.col("x") > 10, "hi", "lo").alias("y")).collect()]
    assert got == ["lo", None, "hi"]


def test_str_c_and_row_sum(spark):
    df = spark.createDataFrame([("a", None, 1, None), ("a", "b", 2, 3)], "x string, y string, p int, q int")
    r = df.select(str_c("x", "y", sep="-").alias("s"), row_sum("p", "q", na_rm=True).alias("t"),
                  row_sum("p", "q", na_rm=False).alias("u")).collect()
    assert r[0].s is None and r[1].s == "a-b"
    assert (r[0].t, r[0].u) == (1, None) and r[1].u == 5


def test_split_part_missing_is_empty(spark):
    df = spark.createDataFrame([("R-CA",), ("R",), (None,)], "s string")
    got = [tuple(r) for r in df.select(split_part("s", "-", 1), split_part("s", "-", 2)).collect()]
    assert got == [("R", "CA"), ("R", ""), (None, None)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("John Smith (R-TX) (x)",), ("No parens",), (None,)], "s string")
    r = df.select(X.paren_text("s").alias("p"), X.remove_paren("s").alias("n"),
                  X.first_match("s", r"[A-Z]{2}").alias("m"),
                  X.replace_first("s", "o", "0").alias("f")).collect()
    assert r[0].p == "R-TX" and r[0].n == "John Smith (x)" and r[0].m == "TX" and r[0].f == "J0hn Smith (R-TX) (x)"
    assert r[1].p is None and r[1].n == "No parens" and r[1].m is None
    assert r[2].p is None


def test_names(spark):
    df = spark.createDataFrame([("Smith-Jones, J. Robert",), ("Peña, Ana",), ("Solo",)], "s string")
    r = df.select(X.flip_name("s").alias("f"), F.array_join(X.name_tokens("s"), " ").alias("t"),
                  X.fold_accents("s").alias("a")).collect()
    assert r[0].f == "J. Robert Smith-Jones"
    assert r[0].t == "Smith Jones Robert"
    assert r[1].a == "Pena, Ana" and r[2].f == "Solo"
    ln = spark.createDataFrame([("John Smith Jr",), ("Al Gore III",)], "s string").select(X.last_name("s")).collect()
    assert [x[0] for x in ln] == ["Smith", "Gore"]


def test_ordinals(spark):
    df = spark.createDataFrame([(101,), (102,), (103,), (104,), (111,), (112,), (113,)], "n int")
    src = [r[0] for r in df.select(X.ordinal_suffix(F.col("n"))).collect()]
    eng = [r[0] for r in df.select(X.ordinal_suffix(F.col("n"), upto=None)).collect()]
    assert src == ["st", "nd", "rd", "th", "th", "th", "th"]
    assert eng == ["st", "nd", "rd", "th", "th", "th", "th"]
    assert [r[0] for r in spark.createDataFrame([(21,), (111,), (121,)], "n int")
            .select(X.ordinal_suffix(F.col("n"), upto=None)).collect()] == ["st", "th", "st"]


def test_assembly_and_cycles(spark):
    df = spark.createDataFrame([(1970,), (1971,), (1993,), (2016,), (2017,)], "y int")
    cg = [r[0] for r in df.select(C.assembly_of_year(F.col("y"))).collect()]
    assert cg == [91, 92, 103, 114, 115]
    c = spark.createDataFrame([(101,), (103,)], "c int").select(
        C.cycle_of_assembly(F.col("c"), "closing"), C.cycle_of_assembly(F.col("c"), "electing")).collect()
    assert [tuple(r) for r in c] == [(1990, 1988), (1994, 1992)]


def test_votes_and_districts(spark):
    df = spark.createDataFrame([("1,234,567",), ("Unopposed",), ("N/A",), (" 12 ",), (None,)], "v string")
    got = [r[0] for r in df.select(C.parse_votes("v")).collect()]
    assert got[0] == 1234567.0 and got[1] == float("inf") and got[2] is None and got[3] == 12.0 and got[4] is None
    d = spark.createDataFrame([("District 4",), ("At Large",), ("District x",)], "d string") \
        .select(C.district_number("d").alias("n")).collect()
    assert [r.n for r in d] == [4, 1, None]


def test_degree_days_half_even(spark):
    # d = t*9/5 + 32 - 65: t = 20 -> 3.0; t = -10 -> -51; t = 17.5 -> -1.5 (half -> even 2)
    df = spark.createDataFrame([(20.0,), (-10.0,), (None,), (17.5,)], "t double")
    r = df.select(C.cooling_degree_days("t").alias("c"), C.heating_degree_days("t").alias("h")).collect()
    assert (r[0].c, r[0].h) == (3.0, 0.0)
    assert (r[1].c, r[1].h) == (0.0, 51.0)
    assert r[2].c is None and r[2].h is None
    assert (r[3].c, r[3].h) == (0.0, 2.0)


def test_year_repair_and_units(spark):
    df = spark.createDataFrame([(0, 5.0), (97, 5.0), (1989, 5000.0), (2001, 7.0)], "y int, g double")
    r = df.select(C.repair_year("y").alias("y"), C.generation_mwh("g", "y").alias("g")).collect()
    assert [x.y for x in r] == [2000, 1997, 1989, 2001]
    assert r[2].g == 5.0 and r[3].g == 7.0


def test_dates(spark):
    df = spark.createDataFrame([("Jan. 3, 1995",), ("January 3, 1995",), ("Sept. 9, 2001",), ("x",),
                                ("Dec 22, 19942",)], "s string")
    r = df.select(D.month_day_year("s").alias("d"), D.month_day_year(D.cut_year_footnote("s")).alias("f")).collect()
    assert r[0].d == dt.date(1995, 1, 3) and r[1].d == dt.date(1995, 1, 3)
    assert r[3].d is None
    assert r[4].f == dt.date(1994, 12, 22)
    c = spark.createDataFrame([("20160229",), ("20150229",)], "s string").select(D.compact_date("s")).collect()
    assert c[0][0] == dt.date(2016, 2, 29) and c[1][0] is None


def test_contains_any(spark):
    df = spark.createDataFrame([("John Smithers", ["smith", "x"]), ("Ann Lee", ["Bo"]), ("Al", [""]), ("B", None)],
                               "n string, t array<string>")
    assert [r[0] for r in df.select(X.contains_any("n", "t")).collect()] == [True, False, False, None]


def test_strict_min_max_cycle_inverse(spark):
    from polidata.functions.nullsafe import strict_max, strict_min
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3), ("b", 5)], "k string, v int")
    got = {r.k: (r.lo, r.hi) for r in df.groupBy("k").agg(strict_min("v").alias("lo"), strict_max("v").alias("hi")).collect()}
    assert got == {"a": (None, None), "b": (3, 5)}
    c = spark.createDataFrame([(1990,), (1992,)], "y int").select(C.assembly_of_cycle(F.col("y"), "closing")).collect()
    assert [r[0] for r in c] == [101, 102]
