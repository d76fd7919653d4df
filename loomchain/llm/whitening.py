"""Whitening of embeddings through the exact characteristic polynomial of their scatter matrix.

Vectors are integers.  Each distinct one counts once: vectors are packed into bytes and grouped, so that a task sends a frequent vector once.  Tasks sum
them and their products exactly, and Spark adds these sums entry by entry.  The matrix n*sum(x x') - S S' has integer entries and is n*n times the
covariance.  Its characteristic polynomial is found modulo primes, dealt to tasks, by reduction to Hessenberg form, and put together by the Chinese
remainder theorem.  As all its roots are real, the number of roots above a point is exactly the number of sign changes of the polynomial shifted there;
halving by these counts isolates the largest roots, with their multiplicities, and halving by signs refines them to ``ROOT_BITS``.  Each root's
component spans the null space of the matrix less the root: inverse iteration in decimal arithmetic of ``DIGITS``, one task for each distinct root.

What the driver holds grows with the square of the vectors' length, never with their number.

Rows whose vector is null or holds null or non-finite entries are left out.  Shorter vectors have zeros behind them up to the longest.  Entries beyond
a long count as the nearest long.  Repeated rows count once for the fit, and each gives its rows.  Of equal roots any orthonormal components are right; the
sign is such that the largest entry, the first of several, is positive.  A component whose eigenvalue is zero has a null ``whitened``; ``explained`` is null if
all are zero, and so is ``identity_error`` without any other component.  A deviation that does not fit a long is null.  Other columns, whatever their names,
are not read.  Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Context, Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import cut, give_back, shuffle_partitions, table
from loomchain.llm.vectors import integer_rows, longest, matrix, narrow, vector_blocks, widened

COMPONENTS = 4
#: Bits of a root that are right, and digits of the arithmetic that finds its component.
ROOT_BITS, DIGITS = 160, 100
#: Rounds of inverse iteration; each one shrinks what is wrong by the root's error over its distance to the next root.
ITERATIONS = 4
#: Bits of the pieces in which tasks return sums of any size.
PIECE = 62
#: Entries below this have sums of products over a block that doubles hold exactly.
LIMB = 20
RESULT_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def _pack(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A vector's bytes depend on it alone, so that equal ones are equal bytes.
            yield pa.RecordBatch.from_arrays([pa.array([narrow(x) for x in matrix(batch.column(0), width)], pa.binary())], names=["x"])
        give_back()

    return run


def products(x: np.ndarray) -> np.ndarray:
    """x' x as Python integers: by doubles, in pieces of few bits where entries have many."""
    limbs = []
    while x.size and (x.max() >= 1 << LIMB or x.min() < -(1 << LIMB)):
        limbs.append((x & (1 << LIMB) - 1).astype(np.float64))
        x = x >> LIMB
    limbs.append(x.astype(np.float64))
    total = 0
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return total


def _sums(width: int):
    """One task's count, sums and sums of products, as (row, column, three pieces); the count is at (-1, -1) and the sums at (-1, column)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in vector_blocks(batches):
            x = np.stack([widened(v.as_py()) for v in batch.column(0)])
            n, sums, total = n + len(x), sums + x.astype(object).sum(axis=0), total + products(x)
        if not n:
            return
        i, j = np.triu_indices(width)
        rows, columns, values = np.concatenate([[-1], np.full(width, -1), i]), np.concatenate([[-1], np.arange(width), j]), [n, *sums.tolist(), *total[i, j].tolist()]
        mask = (1 << PIECE) - 1
        pieces = [pa.array([(int(v) >> PIECE * k) & mask if k < 2 else int(v) >> 2 * PIECE for v in values], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(columns, pa.int32()), *pieces], names=["i", "j", "p0", "p1", "p2"])

    return run


def moments(fit: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """(n, S, n*n times the covariance) of the packed vectors, exact."""
    parts = fit.mapInArrow(_sums(width), "i int, j int, p0 long, p1 long, p2 long")
    whole = parts.groupBy("i", "j").agg(*(F.sum(F.col(f"p{k}").cast("decimal(38,0)")).alias(f"p{k}") for k in range(3)))
    n, sums, total = 0, [0] * width, np.zeros((width, width), object)
    for r in whole.collect():  # one for each pair of dimensions
        value = sum(int(r[f"p{k}"]) << PIECE * k for k in range(3))
        if r["j"] < 0:
            n = value
        elif r["i"] < 0:
            sums[r["j"]] = value
        else:
            total[r["i"], r["j"]] = total[r["j"], r["i"]] = value
    s = np.array(sums, object)
    return n, sums, n * total - np.multiply.outer(s, s)


def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``limit``, which is under 2**32."""

    def is_prime(p: int) -> bool:
        d, s = p - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for a in (2, 3, 5, 7):  # enough for numbers below 3,215,031,751
            if p % a == 0:
                return p == a
            x = pow(a, d, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(s - 1)):
                return False
        return True

    found, p = [], limit - 1 - limit % 2
    while len(found) < count:
        if is_prime(p):
            found.append(p)
        p -= 2
    return found


def polynomial_modulo(a: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - a) modulo a prime below 2**31, from the constant on."""
    h, d = (a % p).astype(np.int64), len(a)
    for k in range(d - 2):
        if not h[k + 1, k]:
            other = np.flatnonzero(h[k + 2 :, k])
            if not len(other):
                continue
            i = k + 2 + other[0]
            h[[k + 1, i]] = h[[i, k + 1]]
            h[:, [k + 1, i]] = h[:, [i, k + 1]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(axis=1)) % p
    # Leading blocks' polynomials, each from those before it.
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, np.int64)
        new[1:] = polys[k - 1, :-1]
        # Products of the subdiagonal from each row down to this one.
        below = np.ones(k, np.int64)
        for i in range(k - 2, -1, -1):
            below[i] = below[i + 1] * h[i + 1, i] % p
        weights = h[:k, k - 1] * below % p
        polys[k] = (new - (polys[:k] * weights[:, None] % p).sum(axis=0)) % p
    return polys[d].tolist()


def characteristic_polynomial(spark: SparkSession, a: np.ndarray) -> list[int]:
    """Coefficients of det(x - a), from the constant on, of a symmetric matrix without negative eigenvalues."""
    d = len(a)
    # No coefficient is over the product of 1 + root, which is greatest if all roots are alike.
    bits = d * (1 + int(np.trace(a)) // d + 1).bit_length() + 2
    primes = primes_below(1 << 31, bits // 30 + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([primes[k]], pa.int64()), pa.array([polynomial_modulo(a, primes[k])], pa.list_(pa.int64()))], names=["p", "c"])

    rows = spark.range(0, len(primes), 1, min(len(primes), shuffle_partitions(spark))).mapInArrow(run, "p long, c array<long>").collect()  # one for each prime
    coefficients, modulus = [0] * (d + 1), 1
    for r in rows:
        p = r["p"]
        inverse = pow(modulus, -1, p)
        coefficients = [c + modulus * ((x - c) * inverse % p) for c, x in zip(coefficients, r["c"])]
        modulus *= p
    return [c - modulus if 2 * c > modulus else c for c in coefficients]


def roots_above(poly: list[int], at: int, scale: int) -> int:
    """How many roots are over at/2**scale, none negative; all roots being real, sign changes of the shifted polynomial tell it."""
    d = len(poly) - 1
    c = np.array([x << scale * (d - k) for k, x in enumerate(poly)], object)
    if at:
        # p(at * y), whose shift by one takes additions only.
        c = c * np.array([at**k for k in range(d + 1)], object)
        c = c[::-1].copy()
        for i in range(d, 0, -1):
            c[: i + 1] = np.add.accumulate(c[: i + 1])
    signs = [x > 0 for x in c.tolist() if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], at: int, scale: int) -> int:
    value = 0
    for k, c in enumerate(reversed(poly)):
        value = value * at + (c << scale * k)
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], most: int, bound: int, bits: int = ROOT_BITS) -> list[tuple[Fraction, int]]:
    """(root, multiplicity) of the largest positive roots, falling, until ``most`` of them are there; none is over ``bound``."""
    wanted, out, taken, hi, scale = min(most, roots_above(poly, 0, 0)), [], 0, bound + 1, 0
    while taken < wanted:
        # As many roots as are taken are over ``hi``.
        lo, below = 0, None
        while below is None or (hi - lo) << bits > lo:
            if hi - lo < 2:
                lo, hi, scale = lo << 16, hi << 16, scale + 16
            mid = (lo + hi) // 2
            if below == taken + 1:
                # A simple root alone between both ends: the sign, which turns at each root, tells its side.
                over = _sign(poly, mid, scale) * (-1) ** taken <= 0
                n = taken + 1 if over else taken
            else:
                n = roots_above(poly, mid, scale)
            if n > taken:
                lo, below = mid, n
            else:
                hi = mid
        out.append((Fraction(lo + hi, 2 << scale), below - taken))
        taken, hi = below, lo
    return out


def null_space(a: np.ndarray, root: Fraction, count: int) -> np.ndarray:
    """``count`` orthonormal vectors (as doubles) that the matrix less ``root`` takes to almost nothing, by inverse iteration."""
    d, digits = len(a), max(DIGITS, 40 + len(str(max(1, int(np.abs(a).max())))))
    with localcontext(Context(prec=digits)):
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        u = np.array([[Decimal(int(x)) for x in row] for row in a], object).reshape(d, d)
        u[np.arange(d), np.arange(d)] -= shift
        least = max(abs(x) for x in u.ravel()) * Decimal(10) ** -(digits - 5) or Decimal(1)
        swaps, factors = [], []
        for k in range(d):
            i = k + int(np.argmax(np.abs(u[k:, k])))
            u[[k, i]] = u[[i, k]]
            if abs(u[k, k]) < least:
                u[k, k] = least
            f = u[k + 1 :, k] / u[k, k]
            u[k + 1 :, k:] -= f[:, None] * u[k, k:]
            swaps.append(i)
            factors.append(f)

        def solved(b: np.ndarray) -> np.ndarray:
            b = b.copy()
            for k in range(d):
                b[[k, swaps[k]]] = b[[swaps[k], k]]
                b[k + 1 :] -= factors[k] * b[k]
            for k in range(d - 1, -1, -1):
                b[k] = (b[k] - (u[k, k + 1 :] * b[k + 1 :]).sum()) / u[k, k]
            return b

        found: list[np.ndarray] = []
        for nth in range(count):
            # A start that no component is likely to be orthogonal to.
            x = np.array([Decimal(1) / (1 + (i * 7919 + nth * 104729) % 1009) for i in range(d)], object)
            for _ in range(ITERATIONS):
                x = solved(x)
                x = x / max(abs(v) for v in x)
                for _ in range(2):
                    for v in found:
                        x = x - v * (v * x).sum()
                x = x / (x * x).sum().sqrt()
            found.append(x)
        out = np.array([[float(v) for v in x] for x in found])
    return out * np.sign(out[np.arange(count), np.abs(out).argmax(axis=1)])[:, None]


def components(spark: SparkSession, a: np.ndarray, most: int = COMPONENTS) -> list[tuple[Fraction, np.ndarray]]:
    """(eigenvalue, unit eigenvector) of the largest positive eigenvalues, falling."""
    if not len(a) or not np.trace(a):
        return []
    poly = characteristic_polynomial(spark, a)
    roots = largest_roots(poly, most, int(np.trace(a)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([null_space(a, *roots[k]).tolist()], pa.list_(pa.list_(pa.float64())))], names=["k", "v"])

    spaces = {r["k"]: r["v"] for r in spark.range(0, len(roots), 1, len(roots)).mapInArrow(run, "k long, v array<array<double>>").collect()}  # one for each root
    return [(root, np.array(v)) for k, (root, _) in enumerate(roots) for v in spaces[k]][:most]


class Whitening:
    """What the tasks need: sums, projections and shares of the variance."""

    def __init__(self, n: int, sums: list[int], a: np.ndarray, found: list[tuple[Fraction, np.ndarray]], most: int):
        self.n, self.sums, self.width, self.count = n, np.array(sums, object), len(sums), min(most, len(sums))
        trace = int(np.trace(a)) if len(a) else 0
        roots = [r for r, _ in found] + [Fraction(0)] * (self.count - len(found))
        self.explained = [float(r / trace) if trace else None for r in roots]
        self.directions = np.array([v for _, v in found]).reshape(len(found), self.width)
        self.scales = np.array([float(r) ** 0.5 for r, _ in found])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, as longs where it fits with the sum of its squares, else as Python integers."""
        most = self.n * int(np.abs(x.astype(object)).max(initial=0)) + max((abs(s) for s in self.sums.tolist()), default=0)
        if self.width * most * most < 1 << 63:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """n*n times the covariance has the root as eigenvalue, so that n falls out of the quotient."""
        return centred.astype(np.float64) @ self.directions.T / self.scales


def _project(w: Whitening):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vector_blocks(batches):
            y = w.centred(matrix(batch.column(1), w.width))
            deviation = [int(v) if v < 1 << 63 else None for v in (y * y).sum(axis=1)]
            values = w.whitened(y)
            for k in range(w.count):
                own = pa.array(values[:, k]) if k < len(w.scales) else pa.nulls(len(y), pa.float64())
                whole = [pa.array([v] * len(y), t) for v, t in ((k + 1, pa.int32()), (w.n, pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *whole, pa.array(deviation, pa.int64()), own, pa.array([w.explained[k]] * len(y), pa.float64())], names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return run


def _fit_values(w: Whitening):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vector_blocks(batches):
            values = w.whitened(w.centred(np.stack([widened(v.as_py()) for v in batch.column(0)])))
            yield pa.RecordBatch.from_arrays([pa.array(values.tolist(), pa.list_(pa.float64()))], names=["w"])

    return run


def identity_error(fit: DataFrame, w: Whitening) -> float | None:
    """The largest entry of the whitened fit list's covariance less the identity; sums run on values less their running means."""
    k = len(w.scales)
    if not k:
        return None
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    values = fit.mapInArrow(_fit_values(w), "w array<double>")
    found = values.agg(*(F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whiten(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """Per row that counts and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark, x = rows.sparkSession, integer_rows(rows)
    width = longest(x)
    fit = cut(x.select("x").mapInArrow(_pack(width), "x binary").distinct(), "fit_list")
    n, sums, a = moments(fit, width)
    w = Whitening(n, sums, a, components(spark, a, most), most)
    return x.select("vec_id", "x").mapInArrow(_project(w), RESULT_SCHEMA).withColumn("identity_error", F.lit(identity_error(fit, w)).cast("double"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
