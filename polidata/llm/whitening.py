"""Embedding whitening from an exact characteristic polynomial.

Entries become integers x = floor(256 c).  Over the distinct integer vectors (the fit list of n) the tasks add up
sums S and products exactly, so n^2 times the covariance is an integer matrix, the scatter n * sum(x x') - S S'.  Its
characteristic polynomial is taken modulo many primes, one prime a task, by reduction to Hessenberg form, and put
together by Chinese remaindering; enough primes are used that the product exceeds twice any coefficient, and one
more checks the result.  All roots are real, so the sign changes of the polynomial shifted by a are exactly the number
of roots above a (Descartes): bisection isolates the largest roots to any precision.  Inverse iteration on the scatter
less a root, in decimal arithmetic, gives its null space; equal roots get orthogonal vectors.

Only the sums, d * d integers for vectors of length d, reach the driver; they do not grow with the rows.

Defined results: rows whose vector is NULL or has NULL or non-finite entries drop out; shorter vectors are filled up with
zeros to the longest; entries beyond 64 bits become the nearest long; components with eigenvalue 0 do not exist (so a
fit list of one vector, or an empty table, gives no rows); a deviation beyond 64 bits is NULL; repeated rows and ids
are rows of their own.  Only the two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polidata.llm.common import written

SCALE = 256
COMPONENTS = 4
#: Bits to which a root is isolated, relative to the largest possible one, and digits of the inverse iteration.
ROOT_BITS = 160
DIGITS = 150
#: Groups in which the sums of the tasks are merged before they go to the driver.
MERGES = 16
LARGEST = (1 << 63) - 1


# -- exact sums ------------------------------------------------------------------------------------------------
def integer_rows(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x) of the rows that take part, x as array<long> of one length."""
    kept = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vec")).filter(
        F.col("vec").isNotNull() & F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf"))))
    return kept.select("vec_id", F.transform("vec", lambda c: F.floor(c.cast("double") * F.lit(float(SCALE)))).alias("x"))


def padded(rows: DataFrame, length: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size("x"))
    return rows.withColumn("x", F.concat("x", zeros))


def long_matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, length)


def products(x: np.ndarray) -> np.ndarray:
    """Sum of x x' as exact integers."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if largest * largest * max(1, len(x)) < 1 << 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T @ y


def exact_sums(fit: DataFrame, length: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, sum of x x') over the fit list: per task, then per group of tasks, then here."""
    upper = np.triu_indices(length)

    def row(part: int, count: int, sums: np.ndarray, prods: np.ndarray) -> pa.RecordBatch:
        values = [str(int(v)) for v in [count, *sums, *prods]]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([values], pa.list_(pa.string()))], names=["part", "sums"])

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        count, sums, prods = 0, np.zeros(length, object), np.zeros(len(upper[0]), object)
        for batch in batches:
            x = long_matrix(batch.column("x"), length)
            count, sums, prods = count + len(x), sums + x.astype(object).sum(axis=0), prods + products(x)[upper]
        if count:
            yield row(TaskContext.get().partitionId() % MERGES, count, sums, prods)

    def merged(table: pa.Table) -> pa.Table:
        total = sum(np.array([int(v) for v in r], object) for r in table["sums"].to_pylist())
        return pa.Table.from_batches([row(0, total[0], total[1:length + 1], total[length + 1:])])

    shape = "part int, sums array<string>"
    rows = fit.mapInArrow(of_task, shape).groupBy("part").applyInArrow(merged, shape).collect()
    total = sum((np.array([int(v) for v in r.sums], object) for r in rows), np.zeros(1 + length + len(upper[0]), object))
    square = np.zeros((length, length), object)
    square[upper] = total[length + 1:]
    square.T[upper] = total[length + 1:]
    return int(total[0]), [int(v) for v in total[1:length + 1]], square.tolist()


def scatter(n: int, sums: list[int], square: list[list[int]]) -> list[list[int]]:
    """n^2 times the covariance."""
    return [[n * square[i][j] - sums[i] * sums[j] for j in range(len(sums))] for i in range(len(sums))]


# -- the polynomial ----------------------------------------------------------------------------------------------
def is_prime(n: int) -> bool:
    """Miller-Rabin with the bases that decide all numbers of 32 bits."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    return all(pow(a, odd, n) == 1 or any(pow(a, odd << t, n) == n - 1 for t in range(twos)) for a in (2, 7, 61))


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, descending, whose product exceeds the bound, and one more."""
    found, product, at = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(at):
            found.append(at)
            product *= at
        at -= 2
    while not is_prime(at):
        at -= 2
    return [*found, at]


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient of a positive semidefinite matrix's polynomial is larger (Maclaurin's inequality)."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d)
    return max(math.comb(d, k) * mean ** k for k in range(d + 1))


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(xI - A) modulo p, lowest power first: Hessenberg form, then its recurrence."""
    a = matrix.copy()
    d = len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            a[[m, pivot]] = a[[pivot, m]]
            a[:, [m, pivot]] = a[:, [pivot, m]]
        factor = a[m + 1:, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1:] = (a[m + 1:] - factor[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1:] * factor % p).sum(axis=1)) % p
    polys = [np.zeros(d + 1, np.int64)]
    polys[0][0] = 1
    for k in range(d):
        nxt = np.roll(polys[k], 1) - a[k, k] * polys[k] % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(a[i + 1, i]) % p
            if not below:
                break
            nxt = nxt - (int(a[i, k]) * below % p) * polys[i] % p
        polys.append(nxt % p)
    return polys[d].tolist()


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(xI - matrix), lowest power first; one prime a row, dealt over the tasks."""
    d = len(matrix)
    primes = primes_beyond(2 * coefficient_bound(matrix))
    flat = [str(v) for r in matrix for v in r]

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [int(v) for v in flat]
        for batch in batches:
            ps = batch.column("p").to_pylist()
            found = [polynomial_mod(np.array([v % p for v in whole], np.int64).reshape(d, d), p) for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    by_prime = {r.p: r.c for r in dealt.mapInArrow(residues, "p long, c array<long>").collect()}
    product = math.prod(primes[:-1])
    weights = [(q := product // p) * pow(q, -1, p) for p in primes[:-1]]
    whole = [sum(by_prime[p][k] * w for p, w in zip(primes, weights)) % product for k in range(d + 1)]
    coefficients = [c - product if 2 * c > product else c for c in whole]
    if [c % primes[-1] for c in coefficients] != [c % primes[-1] for c in by_prime[primes[-1]]]:
        raise ArithmeticError("the characteristic polynomial fails its check prime")
    return coefficients


# -- roots -------------------------------------------------------------------------------------------------------
def roots_above(poly: list[int], at: int) -> int:
    """Number of roots (all real) above an integer: sign changes after a shift by it."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value(poly: list[int], at: int) -> int:
    total = 0
    for c in reversed(poly):
        total = total * at + c
    return total


def largest_roots(poly: list[int], trace: int, count: int) -> list[tuple[int, int]]:
    """The ``count`` largest positive roots, falling and with repeats, as (numerator, bits): numerator / 2^bits, from
    below by less than 2^-ROOT_BITS of the trace."""
    bits = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << (bits * (len(poly) - 1 - i)) for i, c in enumerate(poly)]
    top = (trace + 1) << bits
    positive = roots_above(scaled, 0)
    above = {0: positive, top: 0}
    found = []
    for k in range(1, min(count, positive) + 1):
        low = max(t for t, n in above.items() if n >= k)
        high = min(t for t, n in above.items() if n < k)
        while high - low > 1 and above[low] - above[high] > 1:
            mid = (low + high) // 2
            above[mid] = roots_above(scaled, mid)
            low, high = (mid, high) if above[mid] >= k else (low, mid)
        if high - low > 1:                      # one root in (low, high]: the sign tells on which side it lies
            over = value(scaled, high)
            while high - low > 1:
                mid = (low + high) // 2
                here = value(scaled, mid)
                if over == 0 or (here != 0 and (here > 0) != (over > 0)):
                    low = mid
                else:
                    high, over = mid, here
        found.append((high if value(scaled, high) == 0 else low, bits))
    return found


# -- vectors -----------------------------------------------------------------------------------------------------
def orthogonal(v: list[Decimal], to: list[list[Decimal]]) -> list[Decimal]:
    for u in to:
        dot = sum(a * b for a, b in zip(u, v))
        v = [b - dot * a for a, b in zip(u, v)]
    return v


def unit(v: list[Decimal]) -> list[Decimal]:
    largest = max(abs(x) for x in v)
    v = [x / largest for x in v]
    norm = sum(x * x for x in v).sqrt()
    return [x / norm for x in v]


def solved(a: list[list[Decimal]], b: list[Decimal], tiny: Decimal) -> list[Decimal]:
    """Solution of a y = b by elimination with row pivots; a vanishing pivot counts as tiny."""
    d = len(a)
    rows = [[*r, y] for r, y in zip(a, b)]
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[pivot] = rows[pivot], rows[k]
        if abs(rows[k][k]) < tiny:
            rows[k][k] = tiny
        for i in range(k + 1, d):
            if rows[i][k]:
                f = rows[i][k] / rows[k][k]
                rows[i] = [*rows[i][:k], Decimal(0), *(x - f * y for x, y in zip(rows[i][k + 1:], rows[k][k + 1:]))]
    out = [Decimal(0)] * d
    for k in range(d - 1, -1, -1):
        out[k] = (rows[k][d] - sum(rows[k][j] * out[j] for j in range(k + 1, d))) / rows[k][k]
    return out


def null_vectors(matrix: list[list[int]], roots: list[tuple[int, int]]) -> list[list[float]]:
    """Unit vectors of the null spaces of matrix less each root; those of equal roots are orthogonal."""
    d = len(matrix)
    found: list[list[Decimal]] = []
    with localcontext(Context(prec=DIGITS, Emax=10 ** 9, Emin=-10 ** 9)):
        largest = Decimal(max(sum(abs(v) for v in r) for r in matrix))
        tiny = largest * Decimal(10) ** -(DIGITS - 20)
        exact = [[Decimal(v) for v in r] for r in matrix]
        for k, (numerator, bits) in enumerate(roots):
            root = Decimal(numerator) / Decimal(1 << bits)
            shifted = [[v - root if i == j else v for j, v in enumerate(r)] for i, r in enumerate(exact)]
            v = unit(orthogonal([Decimal(1 + (i * i * (k + 3) + 7 * i * k + i) % 101) for i in range(d)], found))
            for _ in range(3):
                v = unit(orthogonal(unit(solved(shifted, v, tiny)), found))
            found.append(v)
    return [[float(x) for x in v] for v in found]


# -- the operator ------------------------------------------------------------------------------------------------
@dataclass
class Whitening:
    """Fitted parameters: everything is per dimension or component, nothing per row."""

    n: int
    sums: list[int]
    components: np.ndarray          # (k, d) unit vectors
    eigenvalues: list[float]        # of the covariance, falling
    explained: list[float]

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates (rows, k) of integer vectors."""
        centred = self.centred(x).astype(np.float64) / self.n
        return centred @ self.components.T / np.sqrt(np.array(self.eigenvalues))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if self.n * largest + max((abs(s) for s in self.sums), default=0) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        y = self.centred(x)
        if y.dtype != object:
            largest = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
            if largest * largest * max(1, y.shape[1]) <= LARGEST:
                return (y * y).sum(axis=1).tolist()
        return [v if v <= LARGEST else None for v in (y.astype(object) ** 2).sum(axis=1).tolist()]


def fit_whitening(fit: DataFrame, length: int, components: int = COMPONENTS) -> Whitening | None:
    """Parameters from the distinct integer vectors; None without a component."""
    n, sums, square = exact_sums(fit, length)
    if not n:
        return None
    matrix = scatter(n, sums, square)
    trace = sum(matrix[i][i] for i in range(length))
    if not trace:
        return None
    roots = largest_roots(characteristic_polynomial(fit.sparkSession, matrix), trace, components)
    return Whitening(n, sums, np.array(null_vectors(matrix, roots)), [float_ratio(r, b, n * n) for r, b in roots],
                     [float_ratio(r, b, trace) for r, b in roots])


def float_ratio(numerator: int, bits: int, by: int) -> float:
    """numerator / 2^bits / by, correctly rounded (true division of integers is)."""
    return numerator / (by << bits)


def identity_error(fit: DataFrame, length: int, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list less the identity; moments are centred and merged."""
    k = len(model.components)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            if batch.num_rows:
                w = model.projected(long_matrix(batch.column("x"), length))
                c = w - w.mean(axis=0)
                parts.append((len(w), w.mean(axis=0), c.T @ c))
        if parts:
            count, mean, second = merge_moments(parts)
            yield pa.RecordBatch.from_arrays([pa.array([count]), pa.array([mean.tolist()]), pa.array([second.ravel().tolist()])], names=["c", "m", "s"])

    rows = fit.mapInArrow(moments, "c long, m array<double>, s array<double>").collect()      # k * k numbers a task
    count, _, second = merge_moments([(r.c, np.array(r.m), np.array(r.s).reshape(k, k)) for r in rows])
    return float(np.abs(second / count - np.eye(k)).max())


def merge_moments(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    count, mean, second = parts[0]
    for c, m, s in parts[1:]:
        gap = m - mean
        second = second + s + np.outer(gap, gap) * (count * c / (count + c))
        mean, count = mean + gap * (c / (count + c)), count + c
    return count, mean, second


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened_rows(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per remaining row and component its whitened coordinate, and the figures of the fit."""
    spark = df.sparkSession
    rows = integer_rows(df, vec_id, vector)
    length = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not length:
        return spark.createDataFrame([], RESULT)
    rows = padded(rows, length)
    fit = written(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, length)
    if model is None:
        return spark.createDataFrame([], RESULT)
    error, k = identity_error(fit, length, model), len(model.components)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = long_matrix(batch.column("x"), length)
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)), pa.array(np.repeat(np.array(model.deviations(x), object), k), pa.int64()),
                pa.array(model.projected(x).ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(whiten, RESULT)
