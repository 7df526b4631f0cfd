import numpy as np
import pytest
from pyspark.sql import functions as F

from polidata.operators import aggregates as A
from polidata.operators import joins as J
from polidata.operators import quality as Q
from polidata.operators import shape as S
from polidata.operators import windows as W


def test_unpivot_keeps_nulls_and_conserves(spark):
    df = spark.createDataFrame([("01", 1.0, None), ("02", 3.0, 4.0)], "fips string, y1997 double, y1998 double")
    long = S.unpivot(df, ["fips"], ["y1997", "y1998"], "year", "value")
    assert long.count() == 2 * 2
    assert long.filter(F.col("value").isNull()).count() == 1
    assert long.agg(F.sum("value")).first()[0] == 8.0


def test_stack_groups_order(spark):
    df = spark.createDataFrame([(1, "A", 10.0, "B", 5.0)], "id int, DemName string, DemVotes double, "
                                                          "RepName string, RepVotes double")
    out = S.stack_groups(df, ["id"], {"D": {"name": "DemName", "votes": "DemVotes"},
                                      "R": {"name": "RepName", "votes": "RepVotes"}}, label="party")
    assert [tuple(r) for r in out.orderBy("party_order").collect()] == [(1, "D", 1, "A", 10.0), (1, "R", 2, "B", 5.0)]


def test_union_fill_and_position(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 5.0)], "k int, b double")
    u = S.union_fill([a, b])
    assert sorted(u.columns) == ["a", "b", "k"] and u.count() == 2
    p = S.union_by_position([a, spark.createDataFrame([(3, "y")], "kk int, aa string")])
    assert p.columns == ["k", "a"] and p.count() == 2


def test_replicate_zero_gives_no_row(spark):
    df = spark.createDataFrame([("a", 0), ("b", 2), ("c", None)], "x string, n int")
    assert [tuple(r) for r in S.replicate(df, "n").select("x", "rep").collect()] == [("b", 1), ("b", 2)]


def test_split_to_rows(spark):
    df = spark.createDataFrame([(1, "a; b;;c "), (2, None)], "id int, s string")
    got = [tuple(r) for r in S.split_to_rows(df, "s", ";", out="w", keep_pos=True).collect()]
    assert got == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c")]


def _events(spark):
    rows = []
    for u in (1, 2):
        for i in range(40):
            v = f"t{i}" if i % 5 == 0 and not (u == 2 and i < 10) else None
            rows.append((u, i, i // 7, v, (i * 3) % 11 if i % 4 else None))
    return spark.createDataFrame(rows, "u int, i int, day int, v string, seq int")


def test_fill_down_chunked_equals_window(spark):
    e = _events(spark)
    a = W.fill_down(e, "v", ["u"], ["i"], out="f").select("u", "i", "f")
    b = W.fill_down(e, "v", ["u"], ["i"], chunk=F.col("day"), out="f").select("u", "i", "f")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    first_u2 = [r.f for r in b.filter("u = 2").orderBy("i").collect()][:11]
    assert first_u2[:10] == [None] * 10 and first_u2[10] == "t10"


def test_fill_increment_chunked_equals_window(spark):
    e = _events(spark)
    a = W.fill_increment(e, "seq", ["u"], ["i"], out="f").select("u", "i", "f")
    b = W.fill_increment(e, "seq", ["u"], ["i"], chunk=F.col("day"), out="f").select("u", "i", "f")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    rows = {r.i: r.f for r in a.filter("u = 1").collect()}
    assert rows[1] == 3 and rows[2] == 6 and rows[3] == 9 and rows[4] == 10   # 0 -> NULL start, then chain


def test_islands_chunked_equals_window(spark):
    days = [0, 1, 2, 5, 6, 9, 10, 11, 12, 20]
    df = spark.createDataFrame([(1, d) for d in days] + [(2, d) for d in (3, 4)], "u int, d int")
    a = W.islands(df, ["u"], "d").select("u", "d", "island")
    b = W.islands(df, ["u"], "d", chunk=F.floor(F.col("d") / 4)).select("u", "d", "island")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert [r.island for r in a.filter("u = 1").orderBy("d").collect()] == [0, 0, 0, 1, 1, 2, 2, 2, 2, 3]


def test_block_after_marker(spark):
    df = spark.createDataFrame([(1, i, "err" if i in (2, 4) else "ok") for i in range(10)], "u int, i int, t string")
    out = W.block_after_marker(df, ["u"], ["i"], F.col("t") == "err", 3, chunk=F.floor(F.col("i") / 3))
    assert [(r.i, r.offset) for r in out.orderBy("i").collect()] == [(2, 0), (3, 1), (4, 0), (5, 1), (6, 2), (7, 3)]


def test_group_max_keeps_ties_and_dups(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 3), (2, None)], "k int, y int")
    assert W.keep_group_max(df, ["k"], "y").count() == 2
    assert W.duplicate_rows(df, ["k", "y"]).count() == 2


def test_keep_flagged_twins(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 0)], "k int, f int")
    assert sorted(map(tuple, W.keep_flagged_twins(df, ["k"], "f").collect())) == [(1, 1), (2, 0), (2, 0)]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), [50.0, -40.0]])
    rows = [(int(i % 3), float(v)) for i, v in enumerate(vals)] + [(3, 1.0)]
    df = spark.createDataFrame(rows, "g int, x double")
    q = {r.g: r for r in A.exact_quantiles(df, ["g"], "x", [0.25, 0.5, 0.75]).collect()}
    for g in range(3):
        xs = np.array([v for gg, v in rows if gg == g])
        for i, p in enumerate([0.25, 0.5, 0.75]):
            assert q[g][f"q_{i}"] == pytest.approx(np.quantile(xs, p), abs=1e-12)
    assert q[3].q_1 == 1.0


def test_box_stats(spark):
    df = spark.createDataFrame([(1, float(v)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "g int, x double")
    b = A.box_stats(df, ["g"], "x").first()
    assert (b.q1, b.median, b.q3) == (3.0, 5.0, 7.0)
    assert b.whisker_hi == 8.0 and b.n_outliers == 1


def test_top2_ties_by_order(spark):
    df = spark.createDataFrame([(1, 10.0, 3), (1, 10.0, 1), (1, 5.0, 2), (2, 7.0, 9)], "g int, v double, k int")
    got = {r.g: (r.k_1, r.k_2) for r in A.top2(df, ["g"], "v", "k", ["k"]).collect()}
    assert got == {1: (1, 3), 2: (9, None)}


def test_collapse(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "x", 1)], "k int, v string, o int")
    got = {r.k: r.v for r in A.collapse(df, ["k"], "v", order=["o"]).collect()}
    assert got == {1: "a,b", 2: "x"}
    r = spark.createDataFrame([(["a", "a"],), (["a", "b"],)], "v array<string>") \
        .select(A.collapse_repeated(F.col("v"))).collect()
    assert [x[0] for x in r] == ["a", "a,b"]


def test_band_join(spark):
    left = spark.createDataFrame([("CA", 2000), ("TX", 2000)], "st string, y int")
    right = spark.createDataFrame([("CA", 1998, "a"), ("CA", 2003, "b"), ("CA", 2001, "c")], "st string, cyc int, n string")
    out = J.band_join(left, right, ["st"], "y", "cyc", 2)
    assert sorted(r.n for r in out.collect()) == ["a", "c"]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, v int")
    assert sorted(map(tuple, J.null_safe_join(a, b, ["k"]).select("id", "v").collect())) == [(1, 10), (2, 20)]


def test_corrections(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, s string")
    rules = spark.createDataFrame([(1, "A", False), (3, None, True)], "id int, new_value string, set_null boolean")
    got = dict(map(tuple, J.apply_corrections(df, rules, ["id"], "s").collect()))
    assert got == {1: "A", 2: "b", 3: None}


def test_quality(spark):
    df = spark.createDataFrame([(1, "N12345678"), (1, "N1"), (2, None)], "k int, osid string")
    assert Q.key_violations(df, ["k"]).first().n == 2
    good, bad = Q.split_castable(spark.createDataFrame([("1",), ("x",), (None,)], "v string"), "v", "int")
    assert good.count() == 2 and bad.count() == 1
    ok = [r[0] for r in df.select(Q.id_format_ok(F.col("osid"))).collect()]
    assert ok == [True, False, None]
    junk = spark.createDataFrame([("Scattering",), ("Fred Smith",), ("Write-In",), ("Ted Scattered",)], "n string")
    assert [r[0] for r in junk.select(Q.is_junk_label(F.col("n"))).collect()] == [True, False, True, False]
    rv = {r.rule: r.n_failed for r in Q.rule_violations(df, {"has_osid": F.col("osid").isNotNull()}).collect()}
    assert rv == {"has_osid": 1}


def test_set_differences_and_rows_between(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    got = sorted(map(tuple, S.set_differences(a, b).collect()))
    assert got == [(1, "left_only"), (2, "left_only"), (3, "right_only")]
    assert S.set_differences(b, b).count() == 0
    df = spark.createDataFrame([(i,) for i in range(10)], "pos int")
    assert [r.pos for r in W.rows_between(df, "pos", 3, 5).collect()] == [3, 4, 5]


def test_grain_report(spark):
    a = spark.createDataFrame([(1, 2000), (1, 2000), (2, None)], "fips int, year int")
    b = spark.createDataFrame([(1,)], "k int")
    rep = {r.table: (r.n_rows, r.n_dup_keys, r.n_null_keys) for r in
           Q.grain_report({"a": a, "b": b}, {"a": ["fips", "year"], "b": ["k"]}).collect()}
    assert rep == {"a": (3, 1, 1), "b": (1, 0, 0)}


def test_zip_unpivot_all_natural(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x", "y"])], "id int, l array<string>, r array<string>")
    assert [tuple(r) for r in S.zip_positional(df, "l", "r").collect()] == [(1, 0, "a", "x"), (1, 1, "b", "y")]
    w = spark.createDataFrame([("TX", 1.0, 2.0)], "st string, d20160101 double, d20160102 double")
    assert S.unpivot_all_but(w, ["st"], "date", "v").count() == 2
    a = spark.createDataFrame([(1, 2000, "x")], "plant_id int, year int, a string")
    b = spark.createDataFrame([(1, 2000, 5.0), (1, 2001, 6.0)], "plant_id int, year int, v double")
    assert [tuple(r) for r in J.natural_join(a, b).collect()] == [(1, 2000, "x", 5.0)]


def test_top2_of_a_hot_key_in_one_scan(spark):
    """One key holds half the rows; NULL keys and NULL values; the rank limits rows before the shuffle."""
    rows = [(None if i % 50 == 0 else 0 if i % 2 else i % 7, None if i % 11 == 0 else (i * 37) % 101, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int, t int").repartition(6)
    got = {r.k: (r.t_1, r.t_2) for r in A.top2(df, ["k"], "v", "t", ["t"]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        order = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want[k] = (order[0][2], order[1][2])
    assert got == want
    plan = A.top2(df, ["k"], "v", "t", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan and "Join" not in plan
