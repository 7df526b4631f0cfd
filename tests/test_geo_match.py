import math
import random

import duckdb
from pyspark.sql import functions as F

from polidata.operators import geo as G
from polidata.operators import match as M

SQUARE_HOLE = [(0, 0, 0, 0.0, 0.0), (0, 0, 1, 4.0, 0.0), (0, 0, 2, 4.0, 4.0), (0, 0, 3, 0.0, 4.0),
               (0, 1, 0, 1.0, 1.0), (0, 1, 1, 3.0, 1.0), (0, 1, 2, 3.0, 3.0), (0, 1, 3, 1.0, 3.0)]
U_SHAPE = [(1, 0, i, float(x), float(y)) for i, (x, y) in
           enumerate([(5, 0), (8, 0), (8, 3), (7, 3), (7, 1), (6, 1), (6, 3), (5, 3)])]
TWO_PART = [(2, 0, 0, 10.0, 0.0), (2, 0, 1, 11.0, 0.0), (2, 0, 2, 11.0, 1.0), (2, 0, 3, 10.0, 1.0),
            (2, 1, 0, 12.0, 0.0), (2, 1, 1, 13.0, 0.0), (2, 1, 2, 13.0, 1.0), (2, 1, 3, 12.0, 1.0)]


def _edges(spark):
    v = spark.createDataFrame(SQUARE_HOLE + U_SHAPE + TWO_PART, "poly int, ring int, seq int, x double, y double")
    return G.polygon_edges(v, ["poly"]).withColumn("state", F.lit("S"))


def test_point_in_polygon_shapes(spark):
    pts = spark.createDataFrame([
        (1, 0.5, 0.5),   # square, outside hole
        (2, 2.0, 2.0),   # in the hole
        (3, 6.5, 2.0),   # in the notch of the U -> outside
        (4, 5.5, 2.0),   # U left arm
        (5, 12.5, 0.5),  # second part
        (6, 11.5, 0.5),  # between parts
        (7, -1.0, -1.0)], "pid int, x double, y double")
    got = sorted(map(tuple, G.point_in_polygon(pts, _edges(spark), ["poly"], 0.7).collect()))
    assert got == [(1, 0), (4, 1), (5, 2)]


def _brute_nearest(pts, edges):
    out = {}
    for pid, px, py in pts:
        best = None
        for poly, x1, y1, x2, y2 in edges:
            dx, dy = x2 - x1, y2 - y1
            l2 = dx * dx + dy * dy
            t = 0.0 if l2 == 0 else min(1.0, max(0.0, ((px - x1) * dx + (py - y1) * dy) / l2))
            d = math.sqrt((px - (x1 + t * dx)) ** 2 + (py - (y1 + t * dy)) ** 2)
            if best is None or (d, poly) < best:
                best = (d, poly)
        out[pid] = best
    return out


def test_nearest_polygon_matches_brute_force(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.uniform(-20, 30), rnd.uniform(-20, 20)) for i in range(60)]
    e = _edges(spark)
    got = {r.pid: (r.dist, r.poly) for r in G.nearest_polygon(
        spark.createDataFrame(pts, "pid int, x double, y double").withColumn("state", F.lit("S")),
        e, ["state"], "poly", 0.5).collect()}
    edges = [(r.poly, r.x1, r.y1, r.x2, r.y2) for r in e.collect()]
    want = _brute_nearest(pts, edges)
    assert set(got) == set(want)
    for k in want:
        assert got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-12


def test_jaro_udf_against_duckdb(spark):
    pairs = [("MARTHA", "MARHTA"), ("DIXON", "DICKSONX"), ("", ""), ("a", ""), ("Smith, J", "J Smith"),
             ("abc", None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(M.jaro_distance("a", "b")).collect()]
    con = duckdb.connect()
    for (a, b), g in zip(pairs, got):
        if b is None:
            assert g is None
            continue
        want = 1 - con.execute("select jaro_similarity(?, ?)", [a, b]).fetchone()[0]
        assert abs(g - want) < 1e-12


def _brute_match(recs, cands, cut):
    """Reference-style row-at-a-time tiered match (used only as a test oracle)."""
    import re

    def toks(s):
        s = re.sub(r"[,\-.]", " ", s)
        s = re.sub(r"^[A-Z]\s+", " ", s)
        s = re.sub(r"\s+[A-Z]\s+", " ", s)
        return [t for t in re.split(r"\s+", s.strip()) if t]

    out = {}
    for rid, blk, name in recs:
        parts = name.split(",", 1)
        lnm = parts[0].strip()
        fnm = parts[1].strip() if len(parts) > 1 else ""
        rnm = f"{fnm} {lnm}"
        pool = [(cid, cn) for cid, cb, cn in cands if cb == blk]
        lt, rt = [t.lower() for t in toks(lnm)], [t.lower() for t in toks(rnm)]
        h1 = [(cid, cn) for cid, cn in pool if any(t in cn.lower() for t in lt)]
        h2 = [(cid, cn) for cid, cn in pool if any(t in cn.lower() for t in rt)]
        if h1 or h2:
            cand, tier = (h1, 1) if h1 else (h2, 2)
        else:
            cand, tier = pool, 3
        scored = sorted((1 - M.jaro_similarity_py(rnm, cn), cid) for cid, cn in cand)
        if tier == 3:
            scored = [s for s in scored if s[0] <= cut]
        out[rid] = (scored[0][1] if scored else None, tier == 1 if scored else False,
                    len(cand) if tier < 3 else 0)
    return out


def test_blocked_match_against_brute_force(spark):
    cands = [(1, "TX", "John Smith (R)"), (2, "TX", "Jon Smyth"), (3, "TX", "Mary Smithers"),
             (4, "TX", "Robert Lee"), (5, "CA", "John Smith"), (6, "TX", "Jo Smith"),
             (7, "TX", "Ann Kowalski"), (8, "TX", "Anne Kowalsky")]
    recs = [(10, "TX", "Smith, John"), (11, "TX", "Smyth, Jon Q."), (12, "TX", "Lea, Robert E."),
            (13, "TX", "Kowalska, Anna"), (14, "CA", "Doe, Jane"), (15, "NV", "Smith, John"),
            (16, "TX", "Smith-Jones, Mary")]
    r = spark.createDataFrame(recs, "rec_id int, st string, name string")
    c = spark.createDataFrame(cands, "cand_id int, st string, cname string")
    got = {x.rec_id: (x.cand_id, x.last_name, x.matches) for x in
           M.blocked_match(r, "rec_id", "name", c, "cand_id", "cname", ["st"], cut=0.2).collect()}
    assert got == _brute_match(recs, cands, 0.2)


def test_prefix_filter_is_exact(spark):
    rnd = random.Random(11)
    letters = "abcdefgh"
    names = ["".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))) for _ in range(120)]
    recs = [(i, 0, n) for i, n in enumerate(names[:60])]
    cands = [(100 + i, 0, n) for i, n in enumerate(names[60:])]
    r = spark.createDataFrame(recs, "rid int, b int, n string")
    c = spark.createDataFrame(cands, "cid int, b int, n string")
    for cut in (0.1, 0.2, 0.3):
        got = set(map(tuple, M.prefix_candidates(r, "rid", "n", c, "cid", "n", ["b"], cut).collect()))
        need = {(a, b) for a, _, x in recs for b, _, y in cands if 1 - M.jaro_similarity_py(x, y) <= cut}
        assert need <= got
        assert len(got) < len(recs) * len(cands)


def test_cover_cells_lie_inside_and_are_few(spark):
    """Cells of the cover: those inside hold no edge and lie in the polygon; with the border they hold all of it."""
    e = _edges(spark)
    cover = G.polygon_cover(e, ["poly"], 0.03)
    cells = cover.collect()
    edges = [(r.poly, r.x1, r.y1, r.x2, r.y2) for r in e.collect()]

    def odd(poly, px, py):
        return sum((y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1
                   for p, x1, y1, x2, y2 in edges if p == poly) % 2 == 1

    rnd = random.Random(4)
    for c in cells:
        side = 0.03 * G.STEP ** c.lvl
        assert c.inside or c.lvl == 0
        if c.inside:
            assert all(odd(c.poly, (c.cx + rnd.random()) * side, (c.cy + rnd.random()) * side) for _ in range(5))
    assert {c.lvl for c in cells if c.inside} >= {0, 1}
    held = {(c.poly, c.lvl, c.cx, c.cy) for c in cells}
    assert len(held) == len(cells)
    pts = [(i, rnd.uniform(-1, 14), rnd.uniform(-1, 5)) for i in range(400)]
    want = {(i, poly) for i, px, py in pts for poly in (0, 1, 2) if odd(poly, px, py)}
    frame = spark.createDataFrame(pts, "pid int, x double, y double")
    assert {tuple(r) for r in G.point_in_polygon(frame, e, ["poly"], 0.03).collect()} == want
    assert {tuple(r) for r in G.point_in_polygon(frame, e, ["poly"], 0.03, cover=cover).collect()} == want


def test_nearest_polygon_of_many_edges_far_and_near(spark):
    """Points far off, on the grid and tied, against a ring of 800 edges; cells far smaller than the map."""
    rnd = random.Random(6)
    ring = [(p, 0, i, p * 12 + (4 + rnd.random()) * math.cos(i * math.tau / 400), (4 + rnd.random()) * math.sin(i * math.tau / 400))
            for p in (0, 1) for i in range(400)]
    e = G.polygon_edges(spark.createDataFrame(ring, "poly int, ring int, seq int, x double, y double"), ["poly"]).withColumn("state", F.lit("S"))
    pts = [(i, rnd.uniform(-300, 300), rnd.uniform(-300, 300)) for i in range(30)] + \
        [(100 + i, float(i), 0.0) for i in range(-6, 20)] + [(200, 0.0, 1e6)]
    frame = spark.createDataFrame([(*p, "S") for p in pts] + [(300, 0.0, 0.0, "T")], "pid int, x double, y double, state string")
    got = {r.pid: (r.poly, r.dist) for r in G.nearest_polygon(frame, e, ["state"], "poly", 0.05).collect()}
    want = _brute_nearest(pts, [(r.poly, r.x1, r.y1, r.x2, r.y2) for r in e.collect()])
    assert set(got) == set(want)
    assert all(got[i][0] == want[i][1] and abs(got[i][1] - want[i][0]) <= 1e-9 * max(1, want[i][0]) for i in want)
