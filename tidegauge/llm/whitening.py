"""Whitening of vectors by components from the exact characteristic polynomial of their scatter.

Entries become integers, so the scatter of the distinct vectors is an integer matrix and known exactly:
tasks add up products, Spark adds up the tasks. Its characteristic polynomial is computed modulo as many
31-bit primes as its largest coefficient can need, each by reduction to Hessenberg form, and put together
by Chinese remaindering. All roots are real and none is negative, so the sign changes of the shifted
polynomial count the roots above any point exactly, which isolates the largest ones to a grid far finer
than double precision. A component is the null space of the scatter less its root, found by inverse
iteration in fixed-point arithmetic of several hundred bits. Roots that the grid does not tell apart
share one space of several dimensions.

Primes and roots are dealt to tasks. Whatever reaches the driver has a size set by the number of
dimensions, not of rows: the scatter, the polynomial and the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidegauge.llm.rows import Carried, own
from tidegauge.session import Scratch

ADDED = ("n", "deviation", "whitened", "explained", "identity_error")
LARGEST = 2.0**56  # entries at and beyond it have no long after scaling by 64
GRID_BITS = 96  # roots are located to 2 ** -GRID_BITS, in units of the integer scatter
GUARD_BITS = 128  # further digits in the solution of equations
_LIMB, _LIMBS = 32, 6
_EXACT = 1 << 53  # doubles hold all integers up to it

# -- exact sums over the rows ---------------------------------------------------------------------


def gram(x: np.ndarray) -> np.ndarray:
    """Exact products of the columns of an integer matrix, as Python integers."""
    most = max(abs(int(x.min())), abs(int(x.max())), 1) if x.size else 1
    rows = _EXACT // (most * most)
    if not rows:
        wide = x.astype(object)
        return wide.T.dot(wide)
    total = np.full((x.shape[1], x.shape[1]), 0, object)
    for a in range(0, len(x), rows):
        part = x[a : a + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)  # no sum is rounded
    return total


def _limbs(values: list[int]) -> list[list[int]]:
    """Integers of up to 190 bits as digits that tables can add up: all but the last are not negative."""
    last = _LIMB * (_LIMBS - 1)
    low = [[(v >> _LIMB * k) & (1 << _LIMB) - 1 for v in values] for k in range(_LIMBS - 1)]
    return [*low, [v >> last for v in values]]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


_SUMS = "i int, j int, " + ", ".join(f"l{k} long" for k in range(_LIMBS))


def _sums(batches, dims: int, origin: int) -> Iterator[pa.RecordBatch]:
    """Of one task: products (i, j), sums (i, -1) and number (-1, -1) of the vectors less ``origin``."""
    n, sums, products = 0, np.full(dims, 0, object), np.full((dims, dims), 0, object)
    for batch in batches:
        x = _matrix(batch.column("x"), dims) - origin
        n += len(x)
        small = not x.size or max(abs(int(x.min())), abs(int(x.max()))) * len(x) < 1 << 62
        sums = sums + (x if small else x.astype(object)).sum(axis=0)
        products = products + gram(x)
    if n:
        i, j = np.triu_indices(dims)
        left = np.concatenate([i, np.arange(dims), [-1]])
        right = np.concatenate([j, np.full(dims, -1), [-1]])
        values = [*map(int, products[i, j]), *map(int, sums), n]
        columns = [pa.array(left, pa.int32()), pa.array(right, pa.int32())]
        columns += [pa.array(limb, pa.int64()) for limb in _limbs(values)]
        yield pa.record_batch(columns, names=["i", "j", *(f"l{k}" for k in range(_LIMBS))])


def exact_scatter(fit: DataFrame, dims: int, origin: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors x, their sums less ``origin``, and n times the sum of their products about the mean."""
    parts = fit.mapInArrow(lambda it: _sums(it, dims, origin), _SUMS)
    rows = parts.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS)]).collect()
    n, sums, products = 0, [0] * dims, np.full((dims, dims), 0, object)
    for row in rows:
        value = sum(row[2 + k] << _LIMB * k for k in range(_LIMBS))
        if row.i < 0:
            n = value
        elif row.j < 0:
            sums[row.i] = value
        else:
            products[row.i, row.j] = products[row.j, row.i] = value
    s = np.array(sums, object)
    return n, sums, n * products - np.outer(s, s)


# -- the characteristic polynomial ----------------------------------------------------------------


def primes_below(limit: int, count: int) -> list[int]:
    """The largest ``count`` primes below ``limit``, which is at most 3e9."""

    def prime(m: int) -> bool:
        if any(m % p == 0 for p in (2, 3, 5, 7)):
            return False
        d, s = m - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for base in (2, 3, 5, 7):  # these four decide below 3.2e9
            x = pow(base, d, m)
            if x not in (1, m - 1) and all((x := x * x % m) != m - 1 for _ in range(s - 1)):
                return False
        return True

    found, m = [], limit - 1
    while len(found) < count:
        if prime(m):
            found.append(m)
        m -= 1
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest first, of the characteristic polynomial modulo a prime below 2 ** 31."""
    h = np.array(matrix % p, np.int64)
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(axis=1)) % p
    # Polynomials of the leading blocks, each from all before it.
    leading = np.zeros((d + 1, d + 1), np.int64)
    leading[0, 0] = 1
    for k in range(1, d + 1):
        own_row = -h[k - 1, k - 1] * leading[k - 1] % p
        own_row[1:] += leading[k - 1, :-1]
        if k > 1:
            chain, weights = 1, np.empty(k - 1, np.int64)
            for i in range(k - 1, 0, -1):  # along the subdiagonal upwards
                chain = chain * int(h[i, i - 1]) % p
                weights[i - 1] = chain * int(h[i - 1, k - 1]) % p
            own_row -= (weights[:, None] * leading[: k - 1] % p).sum(axis=0)
        leading[k] = own_row % p
    return leading[d]


def primes_needed(matrix: np.ndarray) -> int:
    """How many 31-bit primes tell the coefficients of a positive semidefinite matrix apart.

    The k-th elementary symmetric function of d roots is at most that of d equal ones of the same sum.
    """
    d, trace = len(matrix), max(sum(int(v) for v in matrix.diagonal()), 1)
    root = -(-trace // d)
    bits = max((math.comb(d, k) * root**k).bit_length() for k in range(d + 1))
    return (bits + 2) // 30 + 1


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """The integers, of either sign, that have these residues."""
    values, modulus = np.full(len(residues[0][1]), 0, object), 1
    for p, row in residues:
        step = (np.array(row, object) - values) * pow(modulus, -1, p) % p
        values, modulus = values + modulus * step, modulus * p
    return [int(v) - modulus if 2 * v > modulus else int(v) for v in values]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients, lowest first, of a positive semidefinite integer matrix; primes are dealt to tasks."""
    primes = primes_below(1 << 31, primes_needed(matrix))
    shared = spark.sparkContext.broadcast(matrix.tolist())

    def compute(batches):
        held = np.array(shared.value, object).reshape(matrix.shape)
        for batch in batches:
            chosen = batch.column("p").to_pylist()
            rows = [polynomial_mod(held, p).tolist() for p in chosen]
            yield pa.record_batch([batch.column("p"), pa.array(rows, pa.list_(pa.int64()))], names=["p", "c"])

    table = spark.createDataFrame([(p,) for p in primes], "p long")
    tasks = min(len(primes), max(spark.sparkContext.defaultParallelism, 1))
    found = table.repartition(tasks).mapInArrow(compute, "p long, c array<long>").collect()
    return remaindered(sorted((r.p, r.c) for r in found))


# -- its largest roots ----------------------------------------------------------------------------


def _shifted(polynomial: list[int], by: int) -> list[int]:
    """Coefficients about another point."""
    out = list(polynomial)
    for i in range(len(out) - 1):
        for k in range(len(out) - 2, i - 1, -1):
            out[k] += by * out[k + 1]
    return out


def roots_above(polynomial: list[int], point: int) -> int:
    """Number of roots above a point, with multiplicity, of a polynomial whose roots are all real.

    For those Descartes' rule of signs is exact.
    """
    signs = [c > 0 for c in _shifted(polynomial, point) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(polynomial: list[int], at: int) -> int:
    out = 0
    for c in reversed(polynomial):
        out = out * at + c
    return out


def largest_roots(polynomial: list[int], count: int, bits: int = GRID_BITS) -> list[tuple[int, int]]:
    """The largest positive roots in units of 2 ** -bits, with multiplicity, in falling order.

    A root is given as the end of the unit that it lies in, roots in one unit as one. Enough are given
    for ``count`` in all, or all there are.
    """
    d = len(polynomial) - 1
    fine = [c << bits * (d - k) for k, c in enumerate(polynomial)]
    high = 1
    while roots_above(fine, high):
        high *= 2
    total = roots_above(fine, 0)
    found, taken = [], 0
    intervals = [(0, high, total, 0)]  # open below, closed above, with the roots above each end
    while intervals and taken < count:
        low, high, above_low, above_high = intervals.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if inside > 1 and high - low > 1:
            middle = (low + high) // 2
            above = roots_above(fine, middle)
            intervals += [(low, middle, above_low, above), (middle, high, above, above_high)]
            continue
        at_high = _value(fine, high) if inside == 1 else 0
        while at_high and high - low > 1:  # one simple root: its sign tells on which side it is
            middle = (low + high) // 2
            value = _value(fine, middle)
            if value == 0 or (value > 0) == (at_high > 0):
                high, at_high = middle, value
            else:
                low = middle
        found.append((high, inside))
        taken += inside
    return found


# -- null spaces ----------------------------------------------------------------------------------


def null_space(matrix: np.ndarray, root: int, count: int, bits: int = GRID_BITS) -> np.ndarray:
    """``count`` orthonormal vectors, as rows, that the matrix only stretches by ``root`` * 2 ** -bits.

    Inverse iteration: equations with the matrix less its root are solved until the vectors stay.
    """
    d = len(matrix)
    digits = bits + GUARD_BITS + max(int(v).bit_length() for v in matrix.diagonal())
    one = 1 << digits
    lu = np.array([[int(v) << digits for v in row] for row in matrix], object).reshape(d, d)
    for i in range(d):
        lu[i, i] -= root << digits - bits
    swaps = []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(lu[k + i, k]))
        swaps.append(pivot)
        if pivot != k:
            lu[[k, pivot]] = lu[[pivot, k]]
        if lu[k, k] == 0:
            lu[k, k] = 1  # singular to the last digit: all the better for the iteration
        if k + 1 < d:
            lu[k + 1 :, k] = (lu[k + 1 :, k] << digits) // lu[k, k]
            lu[k + 1 :, k + 1 :] -= lu[k + 1 :, k, None] * lu[k, k + 1 :] >> digits

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for k, pivot in enumerate(swaps):
            x[[k, pivot]] = x[[pivot, k]]
        for k in range(d - 1):
            x[k + 1 :] -= lu[k + 1 :, k] * x[k] >> digits
        for k in range(d - 1, -1, -1):
            rest = (lu[k, k + 1 :] * x[k + 1 :]).sum() >> digits if k + 1 < d else 0
            x[k] = ((int(x[k]) - int(rest)) << digits) // lu[k, k]
        return x

    def orthonormal(vectors: list[np.ndarray]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for v in vectors:
            spare = max(max(abs(int(c)).bit_length() for c in v) - 2 * digits, 0)
            v = v >> spare
            for _ in range(2):
                for u in out:
                    v = v - ((u * int((u * v).sum())) >> 2 * digits)
            length = math.isqrt(int((v * v).sum()))
            out.append((v << digits) // max(length, 1))
        return out

    # Any start will do that is not orthogonal to the space: digits of a fixed linear recurrence.
    state, start = 12345, []
    for _ in range(count):
        row = []
        for _ in range(d):
            state = (state * 6364136223846793005 + 1442695040888963407) & (1 << 64) - 1
            row.append(((state >> 40) - (1 << 23)) << digits - 24)
        start.append(np.array(row, object))
    vectors, still = orthonormal(start), one >> 80
    for _ in range(1000):
        following = orthonormal([solve(v) for v in vectors])
        # The spaces agree when each old vector lies in the new space.
        away = 0
        for v in vectors:
            rest = v
            for u in following:
                rest = rest - ((u * int((u * v).sum())) >> 2 * digits)
            away = max(away, max(abs(int(c)) for c in rest))
        vectors = following
        if away <= still:
            break
    out = np.array([[int(c) / one for c in v] for v in vectors]).reshape(count, d)
    lead = np.abs(out).argmax(axis=1)
    return out * np.sign(out[np.arange(count), lead])[:, None]


def components(spark: SparkSession, matrix: np.ndarray, count: int) -> tuple[list[Fraction], np.ndarray]:
    """The largest positive eigenvalues of an integer scatter, falling, and their unit vectors as rows."""
    d = len(matrix)
    if not any(int(v) for v in matrix.diagonal()):
        return [], np.zeros((0, d))
    roots = largest_roots(characteristic_polynomial(spark, matrix), count)
    shared = spark.sparkContext.broadcast(matrix.tolist())

    def compute(batches):
        held = np.array(shared.value, object).reshape(d, d)
        for batch in batches:
            place, vectors = [], []
            for k, root, many in zip(*(batch.column(c).to_pylist() for c in ("k", "root", "many"))):
                space = null_space(held, int(root), many).tolist()
                place += [k] * many
                vectors += space
            yield pa.record_batch(
                [pa.array(place, pa.int32()), pa.array(vectors, pa.list_(pa.float64()))], names=["k", "v"]
            )

    table = spark.createDataFrame([(k, str(r), m) for k, (r, m) in enumerate(roots)], "k int, root string, many int")
    tasks = min(len(roots), max(spark.sparkContext.defaultParallelism, 1))
    found = table.repartition(tasks).mapInArrow(compute, "k int, v array<double>").collect()
    found.sort(key=lambda r: (r.k, r.v))
    values = [Fraction(root, 1 << GRID_BITS) for root, many in roots for _ in range(many)]
    return values[:count], np.array([r.v for r in found])[:count]


# -- the operator ---------------------------------------------------------------------------------


class Whitening:
    """What tasks need to whiten vectors: n, sums, unit vectors and the eigenvalues of the covariance."""

    def __init__(self, n: int, sums: list[int], origin: int, values: list[float], vectors: np.ndarray):
        self.n, self.sums, self.origin, self.dims = n, sums, origin, len(sums)
        self.values, self.vectors = values, vectors

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x less the sums, as exact integers."""
        most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        bound = self.n * (most + abs(self.origin)) + max(map(abs, self.sums))
        if bound < 1 << 62:
            return self.n * (x - self.origin) - np.array(self.sums, np.int64)
        return self.n * (x.astype(object) - self.origin) - np.array(self.sums, object)

    def deviations(self, y: np.ndarray) -> list[int | None]:
        most = max(abs(int(y.min())), abs(int(y.max()))) if y.size else 0
        if most * most * self.dims >= 1 << 63:
            y = y.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (y * y).sum(axis=1)]

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (y / self.n).astype(np.float64) @ self.vectors.T / np.sqrt(self.values)


def _identity(batches, fitted: Whitening) -> Iterator[pa.RecordBatch]:
    k = len(fitted.values)
    total = np.zeros((k, k))
    for batch in batches:
        w = fitted.whitened(fitted.centred(_matrix(batch.column("x"), fitted.dims)))
        total += w.T @ w
    i, j = np.triu_indices(k)
    yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])


def _apply(batches, fitted: Whitening) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("x")
        fits = column.value_lengths().to_numpy(zero_copy_only=False) == fitted.dims
        y = fitted.centred(_matrix(column.filter(pa.array(fits)), fitted.dims))
        rows, k = int(fits.sum()), len(fitted.values)
        deviations = np.full(len(fits), None, object)
        deviations[fits] = fitted.deviations(y)
        edges = np.concatenate([[0], np.cumsum(np.where(fits, k, 0))]).astype(np.int32)
        flat = fitted.whitened(y).reshape(-1) if rows and k else np.zeros(0)
        yield pa.record_batch(
            [batch.column("row"), pa.array(deviations.tolist(), pa.int64()),
             pa.ListArray.from_arrays(pa.array(edges), pa.array(flat, pa.float64()))],
            names=["row", "deviation", "whitened"],
        )


def as_integers(vector: Column, scale: int, origin: int) -> Column:
    """floor(scale * c) + origin of every entry, exactly."""
    return F.transform(vector, lambda c: F.floor(c * float(scale)) + origin)


def usable(vector: Column) -> Column:
    """Neither null nor empty, all entries finite and, after scaling, within a long."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def whiten(
    df: DataFrame,
    vector_col: str = "embedding",
    count: int = 16,
    keep: list[str] | None = None,
    scale: int = 64,
    origin: int = 1_000_000,
) -> DataFrame:
    """The columns ``keep`` (all by default) of the rows with a usable vector, and of each

    * ``n``, the number of distinct vectors x = floor(scale * c) + origin, which alone are fitted;
    * ``deviation``, the sum over dimensions of (n * x - sum of x) ** 2, exact, null beyond a long;
    * ``whitened``, x less the mean, projected on up to ``count`` components, over the square root of
      their variance; components are by falling variance, those without any are left out;
    * ``explained``, the share of each component in the whole variance;
    * ``identity_error``, how far the covariance of the fitted whitened vectors is from the identity.

    Rows whose vector is null or empty or holds null, non-finite or enormous entries (2 ** 56 and above)
    are left out. Repeated rows and equal vectors stay and have equal results. Vectors of another length
    than most have (the longer one of two) are not fitted; they stay, with a null deviation and an empty
    array. Variance that several components share equally may be split among them in any orthogonal way.
    Without rows or without variance no component is left, and arrays are empty. Columns with the names
    of new ones are replaced. The fit takes actions: counts, the distinct vectors, their scatter.
    """
    spark, carried = df.sparkSession, Carried(df, keep, ADDED)
    vector = own(vector_col).cast("array<double>")
    # The division into integers comes after the filter: entries that it leaves out could not be cast.
    rows = df.select(carried.packed, vector.alias("v")).filter(usable(F.col("v")))
    x = as_integers(F.col("v"), scale, origin).alias("x")
    most = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = most.dims if most else 1
    scratch = Scratch(spark, "whitening")
    fit = scratch.table(rows.filter(F.size("v") == dims).select(x).distinct(), "fit")
    n, sums, scatter = exact_scatter(fit, dims, origin)
    values, vectors = components(spark, scatter, count)
    trace = sum(int(v) for v in scatter.diagonal())
    fitted = Whitening(max(n, 1), sums, origin, [float(v / (n * n)) for v in values], vectors)
    explained = [float(v / trace) for v in values]
    error = None
    if values:
        products = fit.mapInArrow(lambda it: _identity(it, fitted), "i int, j int, s double")
        sums_of = products.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
        error = max(abs(r.s / n - (r.i == r.j)) for r in sums_of)
    scratch.drop("fit")
    schema = T.StructType([
        rows.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ])
    out = rows.select("row", x).mapInArrow(lambda it: _apply(it, fitted), schema)
    shares = F.lit(explained) if explained else F.array().cast("array<double>")
    return out.select(
        *carried.columns(), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares.alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
