import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from polidata.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<double>, q long, code string, d double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, i, "c", 0.5) for i, v in rows], SCHEMA)


def brute(rows, asks, k=10):
    """The contract by definition: every usable distinct row against every other."""
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ok = sorted({(i, tuple(x + 0.0 for x in v)) for i, v in ok})
    out = []
    for i, v in ok:
        if asks(i):
            near = sorted((math.dist(v, u), j) for j, u in ok if j != i and len(u) == len(v))[:k]
            out += [(i, r, j, s) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def check(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(math.isclose(g[3], w[3], rel_tol=1e-12, abs_tol=1e-12) for g, w in zip(got, want))


def test_recall_on_the_whole_table(shipped, sf):
    """All rows ask here, so that the graph is tested everywhere."""
    table = shipped.read.parquet(f"{sf}/embeddings.parquet")
    got = N.nearest_rows(table, F.col("vec_id") % 5 == 0).toPandas()
    rows = table.select("vec_id", "embedding").toPandas()
    x, ids = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy()
    assert sorted(got.query_id.unique()) == sorted(i for i in ids if i % 5 == 0)
    hits = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 11)) and list(g.score) == sorted(g.score)
        hits += len(set(ids[np.lexsort((ids, d))[:10]]) & set(g.vec_id))
        np.testing.assert_allclose(g.score, [d[ids == v][0] for v in g.vec_id], rtol=1e-13)
    assert hits >= 0.9 * len(got)


def test_recall_with_clusters_of_near_copies(shipped):
    """Tight groups, as of near copies, far from one another: neighbours lie in a query's own group."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    x = np.concatenate([c + 1e-4 * rng.normal(size=(60, 24)) for c in centres])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want, got = brute(rows, lambda i: i % 7 == 0), found(N.nearest_rows(frame(shipped, rows), F.col("vec_id") % 7 == 0))
    assert len(got) == len(want)
    assert len({g[:1] + g[2:3] for g in got} & {w[:1] + w[2:3] for w in want}) >= 0.9 * len(want)


def test_odd_rows(shipped):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [5.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [-0.0, 1.0]), (9, [0.0, 1.0]), (100, [1.0, 2.0, 3.0]),
            (101, [1.5, 2.0, 3.0]), (200, [4.0]), (-100, [1e200, 2.0])]
    check(found(N.nearest_rows(frame(shipped, rows), F.col("vec_id") % 100 == 0)), brute(rows, lambda i: i % 100 == 0))


@pytest.mark.parametrize("n", [0, 1, 2, 11])
def test_few_rows_give_all_candidates(shipped, n):
    rows = [(i, [float(i), 1.0]) for i in range(n)]
    check(found(N.nearest_rows(frame(shipped, rows), F.col("vec_id") % 2 == 0)), brute(rows, lambda i: i % 2 == 0))


def test_one_vector_many_times(shipped):
    """Copies: the smallest ids come first, and other vectors still find one another."""
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 1.0, 1.0]) for i in range(0, 300)] + [(i, rng.normal(size=3).tolist()) for i in range(300, 400)]
    check(found(N.nearest_rows(frame(shipped, rows), F.col("vec_id") % 50 == 0)), brute(rows, lambda i: i % 50 == 0))


def test_ties_go_to_the_smaller_id(shipped):
    rows = [(i, [math.cos(i * math.pi / 8), math.sin(i * math.pi / 8), 1.0]) for i in range(16)] + [(100, [0.0, 0.0, 1.0])]
    got = found(N.nearest_rows(frame(shipped, rows), F.col("vec_id") == 100))
    assert len(got) == 10 and all(abs(g[3] - 1) < 1e-12 for g in got)
    flat = [(i, [float(i % 2), 1.0]) for i in range(40)]
    check(found(N.nearest_rows(frame(shipped, flat), F.col("vec_id") % 10 == 0)), brute(flat, lambda i: i % 10 == 0))
