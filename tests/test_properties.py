"""Property tests: skew-safe rewrites give exactly the plain results."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from polidata.operators import aggregates as A
from polidata.operators import shape as S
from polidata.operators import windows as W

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 60), st.one_of(st.none(), st.integers(0, 9))),
    min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]))


@SETTINGS
@given(rows=rows_strategy, width=st.integers(1, 20))
def test_chunked_scans_equal_plain_windows(spark, rows, width):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    chunk = F.floor(F.col("o") / width)
    for op in (W.fill_down, W.fill_increment):
        a = op(df, "v", ["k"], ["o"], out="f").select("k", "o", "f").collect()
        b = op(df, "v", ["k"], ["o"], chunk=chunk, out="f").select("k", "o", "f").collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    a = W.islands(df, ["k"], "o", gap=2).select("k", "o", "island").collect()
    b = W.islands(df, ["k"], "o", gap=2, chunk=chunk).select("k", "o", "island").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    m = F.col("v") == 3
    a = W.block_after_marker(df, ["k"], ["o"], m, 2).select("k", "o", "offset").collect()
    b = W.block_after_marker(df, ["k"], ["o"], m, 2, chunk=chunk).select("k", "o", "offset").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=300))
def test_exact_quantiles_equal_numpy(spark, vals):
    df = spark.createDataFrame([(g, float(x)) for g, x in vals], "g int, x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in A.exact_quantiles(df, ["g"], "x", probs).collect()}
    for g in {g for g, _ in vals}:
        xs = np.array([x for gg, x in vals if gg == g], dtype=float)
        for i, p in enumerate(probs):
            assert got[g][f"q_{i}"] == pytest.approx(float(np.quantile(xs, p)), abs=1e-9)


@SETTINGS
@given(n_rows=st.integers(1, 20), n_cols=st.integers(1, 5))
def test_unpivot_conserves(spark, n_rows, n_cols):
    rows = [(i, *[float(i * j) if (i + j) % 3 else None for j in range(n_cols)]) for i in range(n_rows)]
    schema = "id int, " + ", ".join(f"c{j} double" for j in range(n_cols))
    df = spark.createDataFrame(rows, schema)
    long = S.unpivot(df, ["id"], [f"c{j}" for j in range(n_cols)])
    assert long.count() == n_rows * n_cols
    total = sum(v for r in rows for v in r[1:] if v is not None)
    assert (long.agg(F.sum("value")).first()[0] or 0.0) == pytest.approx(total)


@SETTINGS
@given(left=st.lists(st.tuples(st.integers(0, 2), st.integers(1990, 2000)), min_size=1, max_size=30),
       right=st.lists(st.tuples(st.integers(0, 2), st.integers(1990, 2000), st.integers(0, 9)), min_size=1, max_size=30),
       width=st.integers(0, 3))
def test_band_join_equals_nested_loop(spark, left, right, width):
    from polidata.operators.joins import band_join
    ldf = spark.createDataFrame(left, "k int, y int")
    rdf = spark.createDataFrame(right, "k int, cyc int, v int")
    got = sorted(map(tuple, band_join(ldf, rdf, ["k"], "y", "cyc", width).select("k", "y", "cyc", "v").collect()))
    want = sorted((k, y, c, v) for k, y in left for k2, c, v in right if k == k2 and abs(y - c) <= width)
    assert got == want


POLY = [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (2.5, 3.0), (2.5, 1.0), (1.5, 1.0), (1.5, 3.0), (0.0, 3.0)]
HOLE = [(0.3, 0.3), (1.0, 0.3), (1.0, 0.8), (0.3, 0.8)]


def _inside(px, py, rings):
    k = 0
    for ring in rings:
        for i, (x1, y1) in enumerate(ring):
            x2, y2 = ring[(i + 1) % len(ring)]
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                k += 1
    return k % 2 == 1


@SETTINGS
@given(pts=st.lists(st.tuples(st.floats(-1, 5, allow_nan=False), st.floats(-1, 4, allow_nan=False)),
                    min_size=1, max_size=40),
       cell=st.sampled_from([0.3, 1.0, 7.0]))
def test_point_in_polygon_equals_brute_force(spark, pts, cell):
    from polidata.operators.geo import point_in_polygon, polygon_edges
    verts = [(1, r, i, x, y) for r, ring in enumerate([POLY, HOLE]) for i, (x, y) in enumerate(ring)]
    edges = polygon_edges(spark.createDataFrame(verts, "poly int, ring int, seq int, x double, y double"), ["poly"])
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "pid int, x double, y double")
    got = {r.pid for r in point_in_polygon(p, edges, ["poly"], cell).collect()}
    want = {i for i, (x, y) in enumerate(pts) if _inside(x, y, [POLY, HOLE])}
    assert got == want


NAME_PART = st.text(alphabet="abAB", min_size=1, max_size=5)


@SETTINGS
@given(cands=st.lists(st.tuples(st.integers(0, 1), NAME_PART, NAME_PART), min_size=1, max_size=12),
       recs=st.lists(st.tuples(st.integers(0, 1), NAME_PART, NAME_PART), min_size=1, max_size=8))
def test_blocked_match_equals_row_at_a_time(spark, cands, recs):
    from tests.test_geo_match import _brute_match
    from polidata.operators.match import blocked_match
    c = [(100 + i, b, f"{f} {l}") for i, (b, f, l) in enumerate(cands)]
    r = [(i, b, f"{l}, {f}") for i, (b, f, l) in enumerate(recs)]
    cdf = spark.createDataFrame(c, "cand_id int, blk int, cname string")
    rdf = spark.createDataFrame(r, "rec_id int, blk int, name string")
    got = {x.rec_id: (x.cand_id, x.last_name, x.matches) for x in
           blocked_match(rdf, "rec_id", "name", cdf, "cand_id", "cname", ["blk"], cut=0.2).collect()}
    assert got == _brute_match(r, c, 0.2)
