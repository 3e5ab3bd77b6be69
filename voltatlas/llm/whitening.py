"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

Entries become whole numbers, so the scatter n * sum(x x') - S S' of the
distinct vectors is an integer matrix: every task hands on one exact matrix of
sums. Its characteristic polynomial is found modulo many primes, each by a
reduction to Hessenberg form in a task of its own, and put together by the
Chinese remainder theorem; a bound on the coefficients tells how many primes it
takes. All its roots are real, so Descartes' rule of signs, applied to the
polynomial moved along, counts the roots above a point exactly, multiple ones
included; halving isolates the greatest roots, and the sign of the polynomial narrows
them to hundreds of bits. The components are the null space of the scatter
less a root: inverse iteration in long decimals, orthonormal within equal roots.

The sums grow with the square of the embedding's width, the polynomial with its fourth power
and more; neither grows with the rows, but for a few bits. Only such matrices
and polynomials reach the driver.

Rows: those whose vector is null or empty, holds a null or non-finite entry, or is of another
length than most usable ones (of two lengths as frequent the greater) are left out. Every other row gives a row per
component, repeated rows and equal or null ids included. Components with a
variance of zero do not exist, so there may be fewer than asked for, or none, and
then no rows: for an empty table, a single distinct vector or equal ones. An entry beyond
64 bits counts as the greatest number. A deviation beyond 64 bits is null in ``deviation`` and exact in ``deviation_exact``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.common import pick, stored

COMPONENTS = 4
#: Entries are counted in steps of one over this.
SCALE = 256
#: Bits after the point to which roots are known, and between two roots that count as one.
ROOT_BITS, SAME_BITS = 256, 200
#: Digits inverse iteration works with, and its steps.
DIGITS, STEPS = 160, 3
#: Bits of a part of an exact sum, and parts of a sum: enough for any 64-bit entries.
LIMB, LIMBS = 60, 4


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and x, the entries in whole steps, of the rows whose vector can be used."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    usable = F.coalesce(F.forall("embedding", finite) & (F.size("embedding") > 0), F.lit(False))
    return pick(rows, "vec_id", "embedding").where(usable).select(
        "vec_id", F.transform("embedding", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(0)).alias("x"))


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct vector of the most frequent length once, written once."""
    return stored(vectors.select("x").distinct(), "fit-list")


def width_of(vectors: DataFrame) -> int:
    found = vectors.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return found["width"] if found else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def products(x: np.ndarray) -> np.ndarray:
    """x' x without rounding, as Python numbers."""
    most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    at_once = (1 << 53) // (most * most)
    if not at_once:  # one product alone may pass what a double holds
        whole = x.astype(object)
        return whole.T @ whole
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for start in range(0, len(x), at_once):
        part = x[start:start + at_once].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def sums(fit: DataFrame, width: int) -> np.ndarray:
    """Exact sums of products of the vectors, each led by a 1: count, sums by entry, second moments."""
    upper = np.triu_indices(width + 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1), dtype=object)
        for batch in batches:
            x = matrix(batch.column(0), width)
            if len(x):
                total += products(np.hstack([np.ones((len(x), 1), dtype=np.int64), x]))
        rest = total[upper]
        for limb in range(LIMBS):
            last = limb == LIMBS - 1
            part = [int(value) if last else int(value) & ((1 << LIMB) - 1) for value in rest]
            rest = [int(value) >> LIMB for value in rest]
            at = [n for n, value in enumerate(part) if value]
            if at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array([limb] * len(at), pa.int32()),
                     pa.array([part[n] for n in at], pa.int64())], ["at", "limb", "v"])

    found = fit.select("x").mapInArrow(task, "at int, limb int, v long").groupBy("at", "limb").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # as many as the width's square, whatever the rows
    whole = np.zeros((width + 1, width + 1), dtype=object)
    for at, limb, value in found:
        i, j = upper[0][at], upper[1][at]
        whole[i, j] += int(value) << (LIMB * limb)
    return np.triu(whole) + np.triu(whole, 1).T


def is_prime(n: int) -> bool:
    """Exact for numbers below 2^32."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 11, 13)):
        return n in (2, 3, 5, 7, 11, 13)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):  # fixed values: these bases decide all numbers below 3,215,031,751
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """The greatest primes below 2^31 whose product has more than so many bits."""
    found, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix of residues brought by similarity to one without entries below the first subdiagonal."""
    a, d = a.copy(), len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - factor[:, None] * a[k + 1][None, :]) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * factor[None, :] % p).sum(1)) % p
    return a


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - a) modulo p, from the constant on."""
    h, d = hessenberg(a % p, p), len(a)
    known = np.zeros((d + 1, d + 1), dtype=np.int64)
    known[0, 0] = 1
    for k in range(1, d + 1):  # of the leading k rows and columns, from those of fewer
        known[k, 1:] = known[k - 1, :-1]
        known[k] = (known[k] - h[k - 1, k - 1] * known[k - 1]) % p
        chain = 1
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            known[k] = (known[k] - chain * int(h[i - 1, k - 1]) % p * known[i - 1]) % p
    return known[d]


def characteristic_polynomial(spark: SparkSession, scatter: np.ndarray) -> list[int]:
    """Coefficients of det(x - scatter) from the constant on; the scatter has whole numbers and no negative eigenvalue.

    No coefficient passes the product of (1 + eigenvalue), which is no more than (1 + trace / d)^d.
    """
    d = len(scatter)
    trace = int(sum(scatter[i, i] for i in range(d)))
    primes = primes_for(d * (trace // d + 2).bit_length() + 2)
    shared = spark.sparkContext.broadcast(scatter)  # grows with the width's square

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                found = polynomial_modulo((shared.value % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([found.tolist()], pa.list_(pa.int64()))],
                                                 ["p", "c"])

    count = max(1, min(len(primes) // 4, 2000))
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(count, "p").mapInArrow(
        task, "p long, c array<long>").collect()  # as many as the bits of the polynomial
    return chinese_remainders({row.p: row.c for row in rows})


def chinese_remainders(residues: dict[int, list[int]]) -> list[int]:
    """The whole numbers nearest to zero with the given residues."""
    product, values = 1, None
    for p, found in sorted(residues.items()):
        if values is None:
            product, values = p, list(found)
            continue
        inverse = pow(product, -1, p)
        values = [value + product * ((r - value) * inverse % p) for value, r in zip(values, found)]
        product *= p
    return [value - product if 2 * value > product else value for value in values or []]


def moved(c: list[int], by: int) -> list[int]:
    """Coefficients of the polynomial at x + by."""
    c = list(c)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += by * c[j + 1]
    return c


def roots_above(c: list[int], point: int) -> int:
    """How many roots lie above a point; exact where all roots are real."""
    signs = [value > 0 for value in moved(c, point) if value]
    return sum(one != two for one, two in zip(signs, signs[1:]))


def greatest_roots(c: list[int], count: int, bits: int = ROOT_BITS, same: int = SAME_BITS) -> list[tuple[int, int]]:
    """The greatest positive roots, in steps of 2^-bits, with how often they come, down to so many in all.

    The polynomial has real roots only, none of them negative. Roots less than 2^-same apart count as one.
    """
    zeros = next(n for n, value in enumerate(c) if value)
    c = c[zeros:]
    degree = len(c) - 1
    count = min(count, degree)
    if not count:
        return []
    top = -c[-2] + 1  # above the sum of the roots
    scaled = [value << (bits * (degree - n)) for n, value in enumerate(c)]  # roots count in steps
    at_most = top << bits
    counts: dict[int, int] = {0: degree, at_most: 0}

    def above(point: int) -> int:
        if point not in counts:
            counts[point] = roots_above(scaled, point)
        return counts[point]

    def sign(point: int) -> int:
        value = 0
        for factor in reversed(scaled):
            value = value * point + factor
        return (value > 0) - (value < 0)

    found: list[tuple[int, int]] = []
    known = 0
    while known < count:
        low = max(point for point, n in counts.items() if n > known)
        high = min(point for point, n in counts.items() if n <= known)
        while above(low) - above(high) > 1 and high - low > 1 << (bits - same):
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle) > known else (low, middle)
        times = above(low) - above(high)
        if times == 1:
            side = sign(high)
            while side and high - low > 1:
                middle = (low + high) // 2
                at = sign(middle)
                low, high = (low, middle) if at in (side, 0) else (middle, high)
        found.append((high, times))
        known += times
    return found


def null_space(scatter: list[list[int]], root: int, times: int, bits: int = ROOT_BITS) -> np.ndarray:
    """Orthonormal rows that span the null space of the scatter less a root, by inverse iteration."""
    d = len(scatter)
    with localcontext() as context:
        context.prec = DIGITS
        size = Decimal(max(1, max(abs(value) for row in scatter for value in row)))
        shift = Decimal(root) / (1 << bits)
        a = [[(Decimal(value) - (shift if i == j else 0)) / size for j, value in enumerate(row)]
             for i, row in enumerate(scatter)]
        least = Decimal(10) ** -(DIGITS - 20)
        order = list(range(d))
        for k in range(d):  # rows are exchanged so that the greatest entry leads
            best = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[best], order[k], order[best] = a[best], a[k], order[best], order[k]
            if abs(a[k][k]) < least:
                a[k][k] = least
            lead, head = a[k][k], a[k]
            for i in range(k + 1, d):
                row = a[i]
                if row[k]:
                    factor = row[k] = row[k] / lead
                    for j in range(k + 1, d):
                        row[j] -= factor * head[j]

        def solved(b: list[Decimal]) -> list[Decimal]:
            y = [b[n] for n in order]
            for i in range(d):
                y[i] -= sum((a[i][j] * y[j] for j in range(i)), Decimal(0))
            for i in reversed(range(d)):
                y[i] = (y[i] - sum((a[i][j] * y[j] for j in range(i + 1, d)), Decimal(0))) / a[i][i]
            return y

        rng = np.random.default_rng(5)
        space = [[Decimal(float(value)) for value in rng.standard_normal(d)] for _ in range(times)]
        for _ in range(STEPS):
            done: list[list[Decimal]] = []
            for vector in map(solved, space):
                for _ in range(2):
                    for other in done:
                        along = sum((x * y for x, y in zip(vector, other)), Decimal(0))
                        vector = [x - along * y for x, y in zip(vector, other)]
                    length = sum((x * x for x in vector), Decimal(0)).sqrt()
                    vector = [x / length for x in vector]
                done.append(vector)
            space = done
        out = np.array([[float(x) for x in vector] for vector in space])
    signs = np.sign(out[np.arange(times), np.abs(out).argmax(1)])
    return out * signs[:, None]


def components_of(spark: SparkSession, scatter: np.ndarray, roots: list[tuple[int, int]]) -> np.ndarray:
    """Unit eigenvectors as rows, one task per distinct root."""
    shared = spark.sparkContext.broadcast([[int(value) for value in row] for row in scatter])

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for n, root, times in frame.itertuples(index=False):
                space = null_space(shared.value, int(root), times)
                yield pd.DataFrame({"n": n, "place": range(times), "v": list(map(list, space))})

    rows = [(n, str(root), times) for n, (root, times) in enumerate(roots)]
    found = spark.createDataFrame(rows, "n int, root string, times int").repartition(len(rows)).mapInPandas(
        task, "n int, place int, v array<double>").collect()
    return np.array([row.v for row in sorted(found, key=lambda row: (row.n, row.place))])


class Whitening:
    """What is learned from the fit list: count, sums by entry, eigenvalues and components."""

    def __init__(self, n: int, total: list[int], values: list[float], shares: list[float], components: np.ndarray):
        self.n, self.total, self.values, self.shares, self.components = n, total, values, shares, components

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S without rounding: 64-bit numbers where they are enough, else Python's."""
        most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
        if self.n * most + max(map(abs, self.total)) < 1 << 62:
            return self.n * x - np.array(self.total, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.total, dtype=object)

    def apply(self, deviations: np.ndarray) -> np.ndarray:
        """Whitened entries, one column per component."""
        return (deviations.astype(np.float64) / self.n) @ (self.components / np.sqrt(self.values)[:, None]).T


def learn(fit: DataFrame, width: int, count: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list of vectors of one width; None if nothing varies."""
    spark = fit.sparkSession
    whole = sums(fit, width)
    n, total = int(whole[0, 0]), [int(value) for value in whole[0, 1:]]
    if n < 2:
        return None
    scatter = n * whole[1:, 1:] - np.outer(whole[0, 1:], whole[0, 1:])
    polynomial = characteristic_polynomial(spark, scatter)
    roots, trace = greatest_roots(polynomial, count), -polynomial[-2]
    if not roots:
        return None
    values = [root / (1 << ROOT_BITS) / (n * n) for root, times in roots for _ in range(times)]
    shares = [root / (trace << ROOT_BITS) for root, times in roots for _ in range(times)]
    components = components_of(spark, scatter, roots)
    return Whitening(n, total, values[:count], shares[:count], components[:count])


def identity_error(fit: DataFrame, model: Whitening, width: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list less the identity."""
    shared, count = fit.sparkSession.sparkContext.broadcast(model), len(model.values)
    names = [f"w{n}" for n in range(count)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.apply(shared.value.deviations(matrix(batch.column(0), width)))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, n])) for n in range(count)], names)

    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    row = fit.select("x").mapInArrow(task, ", ".join(f"{name} double" for name in names)).agg(
        *(F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(row[n] - (i == j)) for n, (i, j) in enumerate(pairs))


def schema_of(kind: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("vec_id", kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
        T.StructField("exact", T.StringType())])


def whiten(rows: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error and deviation_exact (decimal digits)."""
    spark = rows.sparkSession
    vectors = whole_vectors(rows)
    schema = schema_of(vectors.schema["vec_id"].dataType)
    width = width_of(vectors)
    vectors = vectors.where(F.size("x") == width)
    model = None
    if width:
        fit = fit_list(vectors)
        model = learn(fit, width, count)
    if model is None:
        found = spark.createDataFrame([], schema)
    else:
        error = identity_error(fit, model, width)
        shared, names = spark.sparkContext.broadcast(model), schema.names

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            many = len(model.values)
            for batch in batches:
                if not batch.num_rows:
                    continue
                deviations = model.deviations(matrix(batch.column(1), width))
                most = int(np.abs(deviations.astype(np.float64)).max()) + 1
                exact = pa.nulls(batch.num_rows * many, pa.string())
                if width * most * most < 1 << 63:
                    total = pa.array(np.repeat((deviations * deviations).sum(1).astype(np.int64), many))
                else:
                    wide = [sum(int(value) ** 2 for value in row) for row in deviations]
                    total = pa.array([value if value < 1 << 63 else None for value in wide for _ in range(many)], pa.int64())
                    exact = pa.array([str(value) for value in wide for _ in range(many)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), many))),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(batch.num_rows * many, model.n, dtype=np.int64)), total,
                    pa.array(model.apply(deviations).ravel()), pa.array(np.tile(model.shares, batch.num_rows)),
                    pa.array(np.full(batch.num_rows * many, error)), exact], names)

        found = vectors.mapInArrow(task, schema)
    return found.withColumn("deviation_exact", F.coalesce("exact", F.col("deviation").cast("string"))).drop("exact")
