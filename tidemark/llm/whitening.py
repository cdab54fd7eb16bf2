"""PCA whitening of vectors from the exact characteristic polynomial of their integer scatter.

Each entry c becomes the integer x = floor(64 c) + 1000000. The scatter
n * sum(x x') - S S' of the distinct vectors is an integer matrix and does not
change when all entries are moved by one number, so the sums are taken over
y = x - 1000000. Then

1. its characteristic polynomial is found modulo many 31-bit primes, each by
   reduction to Hessenberg form, and put together by Chinese remaindering; the
   number of primes follows from a bound on the coefficients, so the result is
   exact;
2. all roots are real, so the sign changes of the polynomial moved by a
   (Descartes) are exactly the number of roots above a: bisection isolates the
   largest roots and Newton steps inside the bracket, in integers, take them to
   `BITS` binary places;
3. the components are null vectors of scatter - root, by inverse iteration in
   integers of twice that precision; roots that agree share one elimination
   and are made orthogonal.

Vectors stay in Spark: distinct ones by an aggregate over compact codes, sums by
partial sums of each batch, primes and roots as rows of small jobs. What the
driver holds depends on the number of dimensions and on log(n) alone.
"""

from __future__ import annotations

from fractions import Fraction
from math import comb, isqrt
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, written

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Binary places of a root.
BITS = 256
#: Roots nearer than 2^-EQUAL count as one root that stands several times.
EQUAL = 160
#: Entries past this lie outside a long; they count as this.
LARGEST = (1 << 62) - OFFSET


# ---------------------------------------------------------------------- codes

def code_of(vector: np.ndarray) -> bytes | None:
    """floor(64 c) of the entries in the fewest bytes that hold all of them, the width first; None if one is not finite."""
    c = vector.astype(np.float64)
    if not np.isfinite(c).all():
        return None
    with np.errstate(over="ignore"):
        y = np.clip(np.floor(SCALE * c), -LARGEST, LARGEST)
    most = float(np.abs(y).max())
    width = 1 if most < 128 else 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    if width == 8:
        return b"\x08" + np.array([max(-LARGEST, min(LARGEST, int(v))) for v in y], np.int64).tobytes()
    return bytes([width]) + y.astype(f"<i{width}").tobytes()


def entries(codes: list[bytes]) -> np.ndarray:
    """The rows of integers of codes, all of one number of dimensions."""
    widths = {c[0] for c in codes}
    if len(widths) == 1:
        w = widths.pop()
        return np.frombuffer(b"".join(c[1:] for c in codes), f"<i{w}").reshape(len(codes), -1).astype(np.int64)
    return np.stack([np.frombuffer(c, f"<i{c[0]}", offset=1).astype(np.int64) for c in codes])


def coded(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dims, code) of the rows whose vector has only finite entries, at least one."""
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            ids, dims, codes = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                values = v.values.to_numpy(zero_copy_only=False)
                code = code_of(values)
                if code is not None:
                    ids.append(i)
                    dims.append(len(values))
                    codes.append(code)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(codes, pa.binary())], names=["id", "dims", "code"])

    return map_batches(rows, run, "id long, dims int, code binary")


# ----------------------------------------------------------------------- sums

def products(y: np.ndarray) -> list[list[int]]:
    """y' y, exactly; row d holds the sums of the entries."""
    y = np.concatenate([y, np.ones((len(y), 1), np.int64)], axis=1)
    most = max(1, max(abs(int(y.min())), abs(int(y.max()))))
    if most * most * len(y) < 1 << 53:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64).tolist()
    z = y.astype(object)
    return z.T.dot(z).tolist()


def moments(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, T, G): number, sums and sums of products of the vectors. Partial sums per batch, then per place of the matrix."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = products(entries(batch.column(0).to_pylist()))
            at = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]
            # a sum may pass 38 digits: in two parts
            parts = [divmod(sums[i][j], 1 << 100) for i, j in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i * (d + 1) + j for i, j in at], pa.int32()), pa.array([str(h) for h, _ in parts]), pa.array([str(x) for _, x in parts])],
                names=["at", "high", "low"])

    cells = map_batches(fit.select("code"), run, "at int, high string, low string")
    summed = cells.groupBy("at").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("high", "low")))
    full = [[0] * (d + 1) for _ in range(d + 1)]
    for r in summed.collect():  # a row per pair of dimensions
        i, j = divmod(r["at"], d + 1)
        full[i][j] = full[j][i] = (int(r["high"]) << 100) + int(r["low"])
    return full[d][d], full[d][:d], [row[:d] for row in full[:d]]


# ----------------------------------------------------------------- polynomial

def primes_below(top: int, bits: int) -> list[int]:
    """Primes from `top` downwards whose product passes 2^bits (Miller-Rabin, certain for numbers of 32 bits)."""
    out, product, p = [], 1, top
    while product.bit_length() <= bits + 1:
        s = ((p - 1) & -(p - 1)).bit_length() - 1
        if p % 2 and all(_witness(a, p, s) for a in (2, 3, 5, 7)):
            out.append(p)
            product *= p
        p -= 1
    return out


def _witness(a: int, p: int, s: int) -> bool:
    x = pow(a, (p - 1) >> s, p)
    return x in (1, p - 1) or any((x := x * x % p) == p - 1 for _ in range(s - 1))


def characteristic(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients (lowest first) of det(x - matrix) modulo the prime p < 2^31, by Hessenberg reduction."""
    h = matrix % p
    d = len(h)
    for k in range(1, d - 1):
        at = k + int(np.argmax(h[k:, k - 1] != 0))
        if not h[at, k - 1]:
            continue
        if at != k:
            h[[k, at]] = h[[at, k]]
            h[:, [k, at]] = h[:, [at, k]]
        u = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - u[:, None] * h[k] % p) % p
        for j in np.flatnonzero(u):  # one by one: sums of many products would pass 63 bits
            h[:, k] = (h[:, k] + u[j] * h[:, k + 1 + j]) % p
    polys = [np.zeros(d + 1, np.int64) for _ in range(d + 1)]
    polys[0][0] = 1
    for k in range(d):
        new = polys[k + 1]
        new[1:] = polys[k][:-1]
        new -= h[k, k] * polys[k] % p
        t = 1
        for i in range(k - 1, -1, -1):
            t = t * int(h[i + 1, i]) % p
            if not t:
                break
            new -= t * int(h[i, k]) % p * polys[i] % p
        new %= p
    return polys[d].tolist()


def coefficient_bits(trace: int, d: int) -> int:
    """Bits of the largest coefficient: the k-th is at most C(d, k) (trace / d)^k, as all roots are real and none is negative."""
    return max((comb(d, k) * (trace // d + 1) ** k).bit_length() for k in range(d + 1)) + 1


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients (lowest first) of the characteristic polynomial: a row per prime, put together by remainders."""
    d = len(matrix)
    primes = primes_below((1 << 31) - 1, coefficient_bits(sum(matrix[i][i] for i in range(d)), d))

    def run(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                left = np.array([[v % p for v in row] for row in matrix], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([characteristic(left, p)], pa.list_(pa.int64()))], names=["p", "c"])

    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 64))
    modulus, out = 1, [0] * (d + 1)
    for r in map_batches(rows, run, "p long, c array<long>").collect():  # d + 1 numbers a prime
        p, inverse = r["p"], pow(modulus, -1, r["p"])
        out = [a + modulus * ((c - a) * inverse % p) for a, c in zip(out, r["c"], strict=True)]
        modulus *= p
    return [a - modulus if 2 * a > modulus else a for a in out]


# ---------------------------------------------------------------------- roots

def moved(poly: list[int], a: int) -> list[int]:
    """Coefficients of poly(x + a)."""
    out = list(poly)
    for i in range(len(out) - 1):
        for j in range(len(out) - 2, i - 1, -1):
            out[j] += a * out[j + 1]
    return out


def changes(poly: list[int]) -> int:
    signs = [c > 0 for c in poly if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def value(poly: list[int], m: int, f: int) -> int:
    """poly(m / 2^f) * 2^(f degree), exactly."""
    out = 0
    for k, c in enumerate(reversed(poly)):
        out = out * m + (c << f * k)
    return out


def derivative(poly: list[int]) -> list[int]:
    return [k * c for k, c in enumerate(poly)][1:]


def root(poly: list[int], rank: int, bits: int = BITS) -> int:
    """floor(r * 2^bits) (or one off) of the rank-th largest root r > 0 (from 1); all roots are real and none is negative."""
    high = 1 << max(1, -poly[-2]).bit_length()  # above the sum of the roots
    low, f = 0, 0  # in units of 2^-f; more than rank - 1 roots lie above low, fewer than rank above high
    base, below = list(poly), changes(poly)  # poly moved to low
    above = 0
    while high - low > 1 or f < bits:
        if below - above == 1 and f >= 8:
            break
        if high - low == 1:
            base, low, high, f = [c << k for k, c in zip(range(len(base) - 1, -1, -1), base, strict=True)], 2 * low, 2 * high, f + 1
        half = (high - low) // 2
        there = moved(base, half)
        count = changes(there)
        if count >= rank:
            base, low, below = there, low + half, count
        else:
            high, above = low + half, count
    low, high = low << bits - f, high << bits - f
    if below - above > 1:
        return low
    slope = derivative(poly)
    rising = value(poly, high, bits) >= 0 if value(poly, high, bits) else value(poly, low, bits) < 0
    at = (low + high) // 2
    while high - low > 1:
        v = value(poly, at, bits)
        if not v:
            return at
        if (v > 0) == rising:
            high = at
        else:
            low = at
        s = value(slope, at, bits)
        step = -(v // s) if s else 0  # v carries one factor 2^bits more than s, so this is in units of 2^-bits
        guess = at + step
        if abs(step) <= 1:
            guess = at + (1 if at == low else -1)
        at = guess if low < guess < high else (low + high) // 2
    return low


# ----------------------------------------------------------------- components

def null_vectors(matrix: list[list[int]], mu: int, times: int, bits: int = BITS) -> list[list[float]]:
    """`times` orthonormal vectors v with matrix v = mu / 2^bits v: inverse iteration with integers of 3 * bits binary places."""
    d, f = len(matrix), 3 * bits
    rows = [[v << f for v in row] for row in matrix]
    for i in range(d):
        rows[i][i] -= mu << f - bits
    drawn = Random(times)
    seeds = [[drawn.randint(-1 << 20, 1 << 20) << f for _ in range(d)] for _ in range(times)]
    vectors = solved(rows, orthonormal(solved(rows, seeds, f), f), f)
    return [[float(Fraction(x, 1 << f)) for x in v] for v in orthonormal(vectors, f)]


def solved(rows: list[list[int]], right: list[list[int]], f: int) -> list[list[int]]:
    """x with rows x = right, for each right side; pivots that vanish count as the smallest number there is."""
    d = len(rows)
    m = [list(r) + [b[i] for b in right] for i, r in enumerate(rows)]
    for k in range(d):
        at = max(range(k, d), key=lambda i: abs(m[i][k]))
        m[k], m[at] = m[at], m[k]
        top = m[k]
        top[k] = top[k] or 1
        for i in range(k + 1, d):
            if m[i][k]:
                u = (m[i][k] << f) // top[k]
                m[i][k + 1:] = [a - (u * b >> f) for a, b in zip(m[i][k + 1:], top[k + 1:], strict=True)]
                m[i][k] = 0
    out = []
    for c in range(d, d + len(right)):
        x = [0] * d
        for i in range(d - 1, -1, -1):
            x[i] = ((m[i][c] << f) - sum(m[i][j] * x[j] for j in range(i + 1, d))) // m[i][i]
        out.append(x)
    return out


def orthonormal(vectors: list[list[int]], f: int) -> list[list[int]]:
    out: list[list[int]] = []
    for v in vectors:
        v = unit(v, f)
        for _ in range(2):
            for u in out:
                s = sum(a * b for a, b in zip(u, v, strict=True)) >> f
                v = [a - (s * b >> f) for a, b in zip(v, u, strict=True)]
            v = unit(v, f)
        out.append(v)
    return out


def unit(v: list[int], f: int) -> list[int]:
    norm = isqrt(sum(a * a for a in v)) or 1
    return [(a << f) // norm for a in v]


def components(spark: SparkSession, matrix: list[list[int]], count: int) -> list[tuple[Fraction, list[float]]]:
    """(eigenvalue, unit eigenvector) of the `count` largest positive eigenvalues of the integer matrix, falling.

    The entry of a vector with the largest size (the first of equal ones) is
    positive. A row per root finds it; a row per group of equal roots finds its vectors.
    """
    if not any(v for row in matrix for v in row):
        return []
    poly = polynomial(spark, matrix)
    count = min(count, changes(poly))

    def find(batches):
        for batch in batches:
            ranks = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ranks, pa.int32()), pa.array([str(root(poly, k)) for k in ranks])], names=["rank", "root"])

    ranks = spark.createDataFrame([(k,) for k in range(1, count + 1)], "rank int").repartition(count)
    roots = sorted((int(r["root"]) for r in map_batches(ranks, find, "rank int, root string").collect()), reverse=True)
    groups: list[list[int]] = []
    for r in roots:
        if groups and groups[-1][0] - r < 1 << BITS - EQUAL:
            groups[-1].append(r)
        else:
            groups.append([r])

    def solve(batches):
        for batch in batches:
            for g, mu, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g], pa.int32()), pa.array([null_vectors(matrix, int(mu), times)], pa.list_(pa.list_(pa.float64())))], names=["g", "v"])

    rows = spark.createDataFrame([(g, str(x[0]), len(x)) for g, x in enumerate(groups)], "g int, mu string, times int").repartition(len(groups))
    vectors = {r["g"]: r["v"] for r in map_batches(rows, solve, "g int, v array<array<double>>").collect()}
    out = []
    for g, own in enumerate(groups):
        for r, v in zip(own, vectors[g], strict=True):
            out.append((Fraction(r, 1 << BITS), [-x for x in v] if max(v, key=abs) < 0 else v))
    return out


# ------------------------------------------------------------------ whitening

def numerators(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S of each row, exactly: 64-bit numbers where they fit, else Python's."""
    most = max(1, max(abs(int(y.min(initial=0))), abs(int(y.max(initial=0)))))
    if n * most + max(map(abs, sums)) < 1 << 62:
        return y * n - np.array(sums, np.int64)
    return y.astype(object) * n - np.array(sums, object)


def projected(y: np.ndarray, n: int, sums: list[int], axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S, whitened values) of each row."""
    exact = numerators(y, n, sums)
    centred = (exact / n).astype(np.float64)
    return exact, centred @ axes.T


def identity_error(fit: DataFrame, n: int, sums: list[int], axes: np.ndarray) -> float:
    """The largest absolute entry of the covariance of the whitened distinct vectors minus the identity."""
    k = len(axes)
    at = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                w = projected(entries(batch.column(0).to_pylist()), n, sums, axes)[1]
                w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
                m = w.T @ w
                yield pa.RecordBatch.from_arrays([pa.array([i * (k + 1) + j for i, j in at], pa.int32()), pa.array([float(m[i, j]) for i, j in at])], names=["at", "s"])

    sums_of = {r["at"]: r["s"] / n for r in map_batches(fit.select("code"), run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()}
    mean = [sums_of[i * (k + 1) + k] for i in range(k)]
    return max(abs(sums_of[i * (k + 1) + j] - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(i, k))


SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row per vector and component (1 has the largest eigenvalue, at most `count`), as in SCHEMA.

    Rows whose vector is null, empty, or holds null or non-finite entries take
    no part; neither do those whose number of dimensions is not the most
    frequent one (the larger of equally frequent ones). Each distinct vector
    counts once in the fit; every row is returned, repeated rows and null keys
    too. Only components with an eigenvalue above 0 exist: none for a single
    distinct vector, and no rows then or for an empty table. Entries past 2^62
    count as 2^62. A deviation of more than 38 digits is null.
    """
    spark = vectors.sparkSession
    codes = written(coded(vectors, key, vector))
    dims = codes.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    empty = spark.createDataFrame([], SCHEMA)
    if dims is None:
        return empty
    d = dims["dims"]
    codes = codes.where(F.col("dims") == d)
    fit = written(codes.select("code").distinct())
    n, sums, squares = moments(fit, d)
    scatter = [[n * squares[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    found = components(spark, scatter, count)
    if not found:
        return empty
    trace = sum(scatter[i][i] for i in range(d))
    explained = [float(e / trace) for e, _ in found]
    # the covariance is scatter / n^2
    axes = np.array([[float(Fraction(x)) for x in v] for _, v in found]) / np.array([_root_of(e) / n for e, _ in found])[:, None]
    error = identity_error(fit, n, sums, axes)
    k = len(found)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            exact, w = projected(entries(batch.column(1).to_pylist()), n, sums, axes)
            most = max(abs(int(exact.min())), abs(int(exact.max())))
            wide = exact if most * most * d < 1 << 62 else exact.astype(object)
            deviation = [str(int(x)) for x in (wide * wide).sum(axis=1)]
            rows = len(w)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.repeat(np.array(deviation, object), k), pa.string()), pa.array(w.ravel()), pa.array(np.tile(explained, rows))],
                names=["vec_id", "component", "deviation", "whitened", "explained"])

    out = map_batches(codes.select("id", "code"), run, "vec_id long, component int, deviation string, whitened double, explained double")
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"),
                      "whitened", "explained", F.lit(error).alias("identity_error"))


def _root_of(e: Fraction) -> float:
    """The square root of a fraction to double precision."""
    return float(Fraction(isqrt((e.numerator << 512) // e.denominator), 1 << 256))
