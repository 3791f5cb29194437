"""Whitening from the exact characteristic polynomial of an integer scatter matrix.

Vectors are integers, so ``M = n * sum(x x') - S S'`` is an integer matrix, n^2 times the covariance,
and is added up without rounding. Its characteristic polynomial is integer too:

1. modulo each of enough primes below 2^31 a task brings M to Hessenberg form and reads the polynomial
   off it; Chinese remainders put the coefficients together, whose size Maclaurin's inequality bounds;
2. all roots are real, so by Descartes' rule the sign changes of ``p(x + a)`` are exactly the number of
   roots above ``a``: bisection over dyadic numbers isolates the largest roots, multiple ones included,
   and goes on by the sign of p alone once a root is by itself;
3. a task per root finds the null space of ``M - root`` by inverse iteration in decimal arithmetic far
   beyond double precision, so that components of close roots are right to the last digit.

Rows are read three times: distinct vectors (the fit list) for the scatter, the kept fit list for the
check of the result, all rows for the projection. What reaches the driver has the size of M.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ebbtide.llm.common import shared_dir
from ebbtide.llm.topk import finite

FACTOR = 64
COMPONENTS = 16
#: Bits and decimal digits to which a root is found and a component is computed.
ROOT_BITS = 200
DIGITS = 90
#: Numbers of a block of vectors inside a task.
BLOCK = 1 << 20
EXACT = 1 << 53


# --- vectors ----------------------------------------------------------------------------------


def _whole(column: pa.Array, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """``floor(factor * c)`` of all components one after the other, and the length of each vector."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(float) * factor)
    if len(flat) and np.abs(flat).max() >= 2**62:
        raise OverflowError("a component does not fit in a long")
    return flat.astype(np.int64), sizes


def _square(flat: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """One row per vector, padded with zeros."""
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _parts(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, BLOCK // max(width, 1))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def _widest(column: pa.Array) -> int:
    return int(max(column.value_lengths().to_numpy(zero_copy_only=False), default=0))


def fit_list(vectors: DataFrame, vector: str, factor: int = FACTOR) -> DataFrame:
    """Each distinct integer vector once, as the bytes of its components without the zeros at its end,
    in a reliable checkpoint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, _widest(batch.column(0))):
                flat, sizes = _whole(part.column(0), factor)
                ends = np.cumsum(sizes)
                coded = [
                    flat[a:b].astype("<i8").tobytes().rstrip(b"\0")
                    for a, b in zip(ends - sizes, ends, strict=True)
                ]
                padded = [c + b"\0" * (-len(c) % 8) for c in coded]
                yield pa.RecordBatch.from_arrays([pa.array(padded, pa.binary())], names=["x"])

    shared_dir(vectors.sparkSession)
    return vectors.select(vector).mapInArrow(run, "x binary").distinct().checkpoint()


def _decoded(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    sizes = pa.compute.binary_length(batch.column(0)).to_numpy(zero_copy_only=False) // 8
    for part in _parts(batch, int(max(sizes, default=0))):
        coded = part.column(0).to_pylist()
        lengths = np.array([len(c) // 8 for c in coded])
        flat = np.frombuffer(b"".join(coded), "<i8")
        yield _square(flat, lengths, int(lengths.max(initial=0)))


# --- scatter ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Scatter:
    """Number of vectors, their sums, and ``n * sum(x x') - S S'``, in Python integers."""

    n: int
    sums: tuple[int, ...]
    matrix: tuple[tuple[int, ...], ...]

    @property
    def trace(self) -> int:
        return sum(row[i] for i, row in enumerate(self.matrix))


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x' y`` without rounding: by floating point where every sum is an exact double."""
    largest = int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0))
    if largest * len(x) < EXACT:
        return (x.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    return x.T.astype(object) @ y.astype(object)


def scatter(fit: DataFrame) -> Scatter:
    """Exact sums of the fit list: a task adds up its part, Spark adds up the parts as decimals. The
    driver receives one number per pair of dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(0, object), np.zeros((0, 0), object)
        for batch in batches:
            for x in _decoded(batch):
                w, d = x.shape[1], len(sums)
                if w > d:
                    narrow, sums, total = (sums, total), np.zeros(w, object), np.zeros((w, w), object)
                    sums[:d], total[:d, :d] = narrow
                n += len(x)
                ones = np.ones((len(x), 1), np.int64)
                sums[:w] += _products(x, ones)[:, 0]
                total[:w, :w] += _products(x, x)
        if not n:
            return
        d = len(sums)
        low, high = np.triu_indices(d)
        i = [-1] + [-1] * d + low.tolist()
        j = [-1, *range(d)] + high.tolist()
        values = [n, *sums.tolist(), *total[low, high].tolist()]
        numbers = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), numbers], names=["i", "j", "value"]
        )

    partial = fit.mapInArrow(run, "i int, j int, value decimal(38,0)")
    rows = partial.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    found = {(r["i"], r["j"]): int(r["value"]) for r in rows}
    n = found.pop((-1, -1), 0)
    d = sum(i < 0 for i, _ in found)
    s = [found[-1, j] for j in range(d)]
    matrix = tuple(
        tuple(n * found.get((min(i, j), max(i, j)), 0) - s[i] * s[j] for j in range(d)) for i in range(d)
    )
    return Scatter(n, tuple(s), matrix)


# --- characteristic polynomial ----------------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test; the bases decide all numbers below 2^32."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd = n - 1
    twos = (odd & -odd).bit_length() - 1
    odd >>= twos
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, from the top, whose product exceeds ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(matrix: Sequence[Sequence[int]], p: int) -> list[int]:
    """Characteristic polynomial modulo ``p < 2^31`` by Hessenberg reduction; lowest power first."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:  # a similarity: rows and columns change places alike
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        share = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - share[:, None] * h[k + 1][None, :]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * share[None, :] % p).sum(axis=1)) % p
    # leading minors of x - H: each from those before it
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(d):
        weights = np.zeros(k + 1, np.int64)
        chain = 1
        for j in range(k, -1, -1):
            weights[j] = int(h[j, k]) * chain % p
            if j:
                chain = chain * int(h[j, j - 1]) % p
        taken = (minors[: k + 1] * weights[:, None] % p).sum(axis=0)
        minors[k + 1, 1:] = minors[k, :-1]
        minors[k + 1] = (minors[k + 1] - taken) % p
    return minors[d].tolist()


def remaindered(residues: Sequence[Sequence[int]], primes: Sequence[int]) -> list[int]:
    """The integers of least size with these residues."""
    product = math.prod(primes)
    shares = [(product // p) * pow(product // p, -1, p) for p in primes]
    out = []
    for column in zip(*residues, strict=True):
        value = sum(r * s for r, s in zip(column, shares, strict=True)) % product
        out.append(value - product if value > product // 2 else value)
    return out


def characteristic_polynomial(spark: SparkSession, s: Scatter) -> list[int]:
    """Integer coefficients, lowest power first, one task per few primes."""
    d, trace, matrix = len(s.matrix), s.trace, s.matrix
    # coefficients are elementary symmetric functions of roots that are not negative
    bound = max((math.comb(d, k) * trace**k // d**k + 1 for k in range(1, d + 1)), default=1)
    primes = primes_beyond(2 * bound + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_pylist()
            values = [polynomial_mod(matrix, primes[i]) for i in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(values, pa.list_(pa.int64()))], names=["id", "c"]
            )

    numbers = spark.range(0, len(primes), 1, min(len(primes), 64))
    found = {r["id"]: r["c"] for r in numbers.mapInArrow(run, "id bigint, c array<bigint>").collect()}
    coefficients = remaindered([found[i] for i in range(len(primes))], primes)
    if d and -coefficients[d - 1] != trace:
        raise RuntimeError("the polynomial does not have the trace of the matrix")
    return coefficients


# --- roots ------------------------------------------------------------------------------------


def _at(at: int, bits: int) -> tuple[int, int]:
    """``at / 2^bits`` without negative bits."""
    return at << max(0, -bits), max(0, bits)


def value_at(c: Sequence[int], at: int, bits: int) -> int:
    """The polynomial at ``at / 2^bits``, times a positive number."""
    at, bits = _at(at, bits)
    value = 0
    for i, v in enumerate(reversed(c)):
        value = value * at + (v << (bits * i))
    return value


def roots_above(c: Sequence[int], at: int, bits: int) -> int:
    """How many roots, with multiplicity, exceed ``at / 2^bits``; all roots must be real."""
    at, bits = _at(at, bits)
    n = len(c)
    a = [v << (bits * (n - 1 - i)) for i, v in enumerate(c)]
    for i in range(n - 1):  # Taylor shift
        for j in range(n - 2, i - 1, -1):
            a[j] += at * a[j + 1]
    signs = [v > 0 for v in a if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


@dataclass(frozen=True)
class Root:
    """``low < root <= low + 1``, both over 2^bits."""

    low: int
    bits: int
    multiplicity: int

    def decimal(self) -> Decimal:
        return Decimal(2 * self.low + 1) / Decimal(2) ** (self.bits + 1)


def largest_roots(c: Sequence[int], most: int, precision: int = ROOT_BITS) -> list[Root]:
    """The largest positive roots of a monic polynomial without negative or complex ones, falling, until
    they count ``most`` or all are found. Roots that agree to ``precision`` bits come as one."""
    zeros = next(i for i, v in enumerate(c) if v)
    c = c[zeros:]
    out: list[Root] = []
    top = max(1, -c[-2] if len(c) > 1 else 1).bit_length()  # no root exceeds their sum
    # (low, bits, roots above low, roots above low + 1); the highest interval is taken first
    todo = [(0, -top, len(c) - 1, 0)]
    while todo and sum(r.multiplicity for r in out) < most:
        low, bits, above, beyond = todo.pop()
        if above == beyond:
            continue
        if low.bit_length() > precision:
            out.append(Root(low, bits, above - beyond))
            continue
        middle, bits = 2 * low + 1, bits + 1
        if above - beyond == 1:
            # beyond all roots p is positive, and it changes sign at each
            value = value_at(c, middle, bits)
            between = beyond if value == 0 or (value > 0) == (beyond % 2 == 0) else above
        else:
            between = roots_above(c, middle, bits)
        todo.append((2 * low, bits, above, between))
        todo.append((middle, bits, between, beyond))
    return out


# --- components -------------------------------------------------------------------------------


def null_space(matrix: Sequence[Sequence[int]], root: Decimal, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors of the null space of ``matrix - root`` by inverse iteration in
    decimals, each with its largest entry positive."""
    d = len(matrix)
    size = len(str(max(1, *(abs(v) for row in matrix for v in row))))
    with localcontext() as context:
        context.prec = DIGITS + size
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        a[np.arange(d), np.arange(d)] -= root
        least = Decimal(10) ** -DIGITS
        order = np.arange(d)
        for k in range(d):
            pivot = k + int(np.argmax(np.abs(a[k:, k])))
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
            if abs(a[k, k]) < least:
                a[k, k] = least  # the root is exact: a vanishing step in its place
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.multiply.outer(a[k + 1 :, k], a[k, k + 1 :])

        def solved(b: np.ndarray) -> np.ndarray:
            x = b[order]
            for k in range(d):
                x[k + 1 :] = x[k + 1 :] - a[k + 1 :, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = (x[k] - a[k, k + 1 :] @ x[k + 1 :] if k + 1 < d else x[k]) / a[k, k]
            return x

        found: list[np.ndarray] = []
        for i in range(count):
            # a start that is hardly orthogonal to the wanted vector
            v = np.array([Decimal(1 + (j * 7919 + i * 104729 + i * i * j) % 1009) for j in range(d)], object)
            for _ in range(3):
                v = solved(v)
                for _ in range(2):
                    for u in found:
                        v = v - u * (u @ v)
                v = v / (v @ v).sqrt()
            if v[int(np.argmax(np.abs(v)))] < 0:
                v = -v
            found.append(v)
        return [[float(x) for x in v] for v in found]


@dataclass(frozen=True)
class Whitening:
    """What turns an integer vector x into ``(x - mean) @ weights``; one column per component."""

    n: int
    sums: tuple[int, ...]
    weights: np.ndarray
    eigenvalues: tuple[float, ...]
    explained: tuple[float, ...]

    @property
    def width(self) -> int:
        return len(self.sums)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array([s / self.n for s in self.sums])) @ self.weights

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """``sum((n * x - S)^2)`` of each row, exact."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        exact = np.int64 if self.width * largest * largest < 2**63 else object
        off = self.n * x.astype(exact) - np.array(self.sums, exact)[None, :]
        out = (off * off).sum(axis=1) if self.width else np.zeros(len(x), np.int64)
        if exact is object and max(out, default=0) >= 2**63:
            raise OverflowError("a deviation does not fit in a long")
        return out.astype(np.int64)


def fit_whitening(spark: SparkSession, s: Scatter, components: int = COMPONENTS) -> Whitening:
    """Components of the covariance with the largest eigenvalues that are not zero, falling."""
    trace = s.trace
    roots = largest_roots(characteristic_polynomial(spark, s), components) if trace else []
    matrix = s.matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_pylist()
            found = [null_space(matrix, roots[i].decimal(), roots[i].multiplicity) for i in at]
            kind = pa.list_(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(found, kind)], names=["id", "v"]
            )

    vectors: list[list[float]] = []
    values: list[Decimal] = []
    if roots:
        numbers = spark.range(0, len(roots), 1, len(roots))
        found = {r["id"]: r["v"] for r in numbers.mapInArrow(run, "id bigint, v array<array<double>>").collect()}
        with localcontext() as context:
            context.prec = DIGITS
            for i, root in enumerate(roots):
                vectors += found[i]
                values += [root.decimal()] * root.multiplicity
    vectors, values = vectors[:components], values[:components]
    with localcontext() as context:
        context.prec = DIGITS
        eigenvalues = tuple(float(v / (s.n * s.n)) for v in values)
        explained = tuple(float(v / trace) for v in values)
        scales = np.array([float(s.n / v.sqrt()) for v in values])
    weights = np.array(vectors).reshape(len(vectors), len(s.sums)).T * scales
    return Whitening(s.n, s.sums, weights, eigenvalues, explained)


# --- whole operator ---------------------------------------------------------------------------


def _merged(a: tuple, b: tuple) -> tuple:
    """Count, means and centred products of two parts together."""
    (n, mean, product), (m, other, more) = a, b
    if not n or not m:
        return b if not n else a
    step = other - mean
    return n + m, mean + step * (m / (n + m)), product + more + np.outer(step, step) * (n * m / (n + m))


def identity_error(fit: DataFrame, whitening: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity. Tasks
    centre their own rows; parts are merged in order of their number, first side by side."""
    k = whitening.weights.shape[1]
    empty = (0, np.zeros(k), np.zeros((k, k)))
    schema = "part bigint, n bigint, mean array<double>, product array<double>"

    def row(part: int, state: tuple) -> pa.RecordBatch:
        n, mean, product = state
        lists = [pa.array([v.ravel().tolist()], pa.list_(pa.float64())) for v in (mean, product)]
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([n], pa.int64()), *lists],
            names=["part", "n", "mean", "product"],
        )

    def read(values: Iterator[tuple]) -> tuple:
        state = empty
        for n, mean, product in values:
            state = _merged(state, (n, np.array(mean), np.array(product).reshape(k, k)))
        return state

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = empty
        for batch in batches:
            for x in _decoded(batch):
                x = np.pad(x, ((0, 0), (0, whitening.width - x.shape[1])))
                y = whitening.apply(x)
                centred = y - y.mean(axis=0)
                state = _merged(state, (len(y), y.mean(axis=0), centred.T @ centred))
        yield row(TaskContext.get().partitionId(), state)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (zip(*[b.column(i).to_pylist() for i in (1, 2, 3)], strict=True) for b in batches)
        yield row(TaskContext.get().partitionId(), read(v for part in parts for v in part))

    parts = fit.mapInArrow(run, schema).repartition(32, "part").sortWithinPartitions("part")
    rows = sorted(parts.mapInArrow(merge, schema).collect(), key=lambda r: r["part"])
    n, _, product = read((r["n"], r["mean"], r["product"]) for r in rows)
    return float(np.abs(product / n - np.eye(k)).max(initial=0.0)) if n else 0.0


def whiten(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    factor: int = FACTOR,
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row with a
    finite vector and each of the first ``components`` components with an eigenvalue above zero.

    A component c of a vector counts as ``floor(factor * c)``; a constant added to it would change no
    column, so none is. Rows whose vector is NULL or holds NULL or non-finite entries are left
    out; a shorter vector counts as filled up with zeros. Equal vectors count once in the fit and are
    each reported; a row without id is reported with a NULL id. With fewer than two distinct vectors, or
    an empty table, there are no components and no rows. Of equal eigenvalues (to 200 bits) any
    orthonormal vectors of their common space are components. Other columns are not read.
    """
    spark = rows.sparkSession
    kept = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")).filter(
        finite(F.col("vector"))
    )
    fit = fit_list(kept, "vector", factor)
    fitted = fit_whitening(spark, scatter(fit), components)
    error = identity_error(fit, fitted)
    k, width = fitted.weights.shape[1], fitted.width
    kind = kept.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widest = _widest(batch.column(1))
            for part in _parts(batch, max(widest, k)):
                # what lies beyond the fitted width is zero in every vector
                x = _square(*_whole(part.column(1), factor), max(widest, width))[:, :width]
                n = len(x)
                ids = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(ids),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * k, fitted.n, np.int64)),
                        pa.array(np.repeat(fitted.deviation(x), k)),
                        pa.array(fitted.apply(x).ravel()),
                        pa.array(np.tile(np.array(fitted.explained), n)),
                        pa.array(np.full(n * k, error)),
                    ],
                    names=[
                        "vec_id",
                        "component",
                        "n",
                        "deviation",
                        "whitened",
                        "explained",
                        "identity_error",
                    ],
                )

    return kept.mapInArrow(
        run,
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double",
    )
