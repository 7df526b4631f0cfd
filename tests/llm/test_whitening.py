import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from polidata.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, x long, n string, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n", 2) for i, v in rows], SCHEMA)


def brute(rows):
    """The contract with numpy's eigenvectors: {(vec_id, component): (n, deviation, |whitened|, explained)}, one per row."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    length = max((len(v) for _, v in kept), default=0)
    xs = [[max(-2 ** 63, min(2 ** 63 - 1, math.floor(256 * c))) for c in v] + [0] * (length - len(v)) for _, v in kept]
    fit = np.array(sorted(set(map(tuple, xs))), float)
    if not len(fit) or not length:
        return []
    n, total = len(fit), [sum(x[j] for x in set(map(tuple, xs))) for j in range(length)]
    centred = fit - fit.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for (i, _), x in zip(kept, xs):
        dev = sum((n * a - s) ** 2 for a, s in zip(x, total))
        y = np.array([(n * a - s) / n for a, s in zip(x, total)])
        for k in range(min(4, length)):
            if e[k] > 1e-9 * e[0] > 0:
                out.append((i, k + 1, n, dev if dev < 2 ** 63 else None, abs(y @ u[:, k]) / math.sqrt(e[k]), e[k] / e.sum()))
    return out


def check(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=repr_key), sorted(want, key=repr_key)):
        assert tuple(g[:4]) == tuple(w[:4])
        assert math.isclose(abs(g[4]), w[4], rel_tol=1e-7, abs_tol=1e-7) and math.isclose(g[5], w[5], rel_tol=1e-9)


def repr_key(r):
    return (r[0] is None, r[0] or 0, r[1], round(abs(r[4]), 5))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_whole_table(shipped, sf):
    table = shipped.read.parquet(f"{sf}/embeddings.parquet")
    got = rows_of(W.whitened_rows(table))
    check([g[:6] for g in got], brute([(r.vec_id, r.embedding) for r in table.collect()]))
    assert {g[6] for g in got} == {got[0][6]} and got[0][6] <= 1e-9


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8])
def test_polynomial_against_known_roots(shipped, size):
    """A diagonal matrix turned by an integer unimodular change keeps its polynomial: coefficients by multiplication."""
    rng = np.random.default_rng(size)
    a = rng.integers(-10 ** 6, 10 ** 6, size=(size + 3, size))
    square = [[int(v) for v in r] for r in (a.T.astype(object) @ a.astype(object))]
    got = W.characteristic_polynomial(shipped, square)
    assert got[-1] == 1 and got[-2] == -sum(square[i][i] for i in range(size))
    by_definition = exact_polynomial(square)
    assert got == by_definition


def exact_polynomial(a):
    """Faddeev-LeVerrier in exact integers."""
    d = len(a)
    c, m = [0] * d + [1], [[0] * d for _ in range(d)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        c[d - k] = -sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) // k
    return c


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=6))
def test_roots_with_repeats(roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    found = W.largest_roots(poly, sum(roots), 4)
    assert [n / (1 << b) for n, b in found] == pytest.approx([r for r in sorted(roots, reverse=True) if r][:4], abs=1e-30)


def test_equal_eigenvalues_give_orthogonal_vectors(shipped):
    rows = [(2 * i + s, [float(1 - 2 * s) if j == i else 0.0 for j in range(5)]) for i in range(5) for s in range(2)]
    got = rows_of(W.whitened_rows(frame(shipped, rows)))
    assert len(got) == 40 and got[0][6] < 1e-12 and all(abs(g[5] - 0.2) < 1e-15 for g in got)


def test_odd_rows(shipped):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [nan, 1.0, 2.0]), (3, [inf, 1.0, 2.0]), (4, [None, 1.0, 2.0]), (5, [0.0, 0.0, 0.0]), (6, [-0.0, 0.001, -0.001]),
            (6, [0.3, 0.4, 1.0]), (6, [0.3, 0.4, 1.0]), (None, [1.0, -2.0, 0.25]), (7, [1.0]), (8, []), (9, [-3.0, 2.5, 1e3])]
    check([g[:6] for g in rows_of(W.whitened_rows(frame(shipped, rows)))], brute(rows))


def test_entries_beyond_64_bits(shipped):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [5.0, 3.0])]
    got = rows_of(W.whitened_rows(frame(shipped, rows)))
    assert [g[3] for g in got if g[0] != 3] == [None] * 4 and len(got) == 6 and got[0][6] < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]])
def test_no_component(shipped, rows):
    assert rows_of(W.whitened_rows(frame(shipped, rows))) == []


def test_copies_count_once_in_the_fit(shipped):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    copies = rows + [(100 + i, rows[3][1]) for i in range(200)]
    got = rows_of(W.whitened_rows(frame(shipped, copies)))
    assert {g[2] for g in got} == {40}
    check([g[:6] for g in got], brute(copies))
