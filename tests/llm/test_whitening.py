"""Whitening against brute force: exact sums, polynomials, roots, and NumPy's eigenvectors."""

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import whitening as W

INF, NAN = float("inf"), float("nan")


def faddeev(matrix):
    """Characteristic polynomial in fractions, lowest power first."""
    d = len(matrix)
    a = np.array([[Fraction(v) for v in row] for row in matrix], object).reshape(d, d)
    eye = np.array([[Fraction(int(i == j)) for j in range(d)] for i in range(d)], object)
    c, m = [Fraction(1)], eye
    for k in range(1, d + 1):
        am = a @ m
        c.append(-sum(am[i, i] for i in range(d)) / k)
        m = am + c[-1] * eye
    return [int(x) for x in reversed(c)]


def grams(seed, d, rank):
    rng = np.random.default_rng(seed)
    x = rng.integers(-40, 40, (rank, d))
    return (x.T @ x).tolist()


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 1), (5, 9), (8, 3), (12, 30)])
def test_polynomial_by_remainders(spark, d, rank):
    for seed in range(3):
        matrix = grams(seed, d, rank)
        s = W.Scatter(1, (0,) * d, tuple(map(tuple, matrix)))
        assert W.characteristic_polynomial(spark, s) == faddeev(matrix)


def test_polynomial_needs_exchanges_of_rows():
    p = W.primes_beyond(1)[0]
    matrix = [[0, 0, 1, 2], [0, 3, 0, 1], [1, 0, 0, 0], [2, 1, 0, 5]]
    assert W.polynomial_mod(matrix, p) == [c % p for c in faddeev(matrix)]


def test_primes():
    assert [n for n in range(60) if W._is_prime(n)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59]
    found = W.primes_beyond(1 << 200)
    assert len(set(found)) == len(found) == 7 and math.prod(found) > 1 << 200
    assert all(all(p % q for q in range(3, 46341, 2)) for p in found)


def product(roots):
    c = [1]
    for r in roots:
        c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
    return c


@pytest.mark.parametrize(
    "roots", [[5], [0, 0, 7], [3, 3, 3, 8], [1, 2, 3, 4, 5, 6], [10**20, 10**20 + 1, 1], [0, 0], [4, 4, 1, 1, 0], [1 << 40, 1 << 40, 1 << 39]]
)
def test_roots_with_multiplicity(roots):
    found = W.largest_roots(product(roots), 100)
    want = sorted({r for r in roots if r}, reverse=True)
    assert [r.multiplicity for r in found] == [roots.count(r) for r in want]
    assert all(abs(Fraction(r.low, 1) / Fraction(2) ** r.bits - w) <= Fraction(1, 1 << 150) * w for r, w in zip(found, want))
    if len(want) > 1:
        assert [r.low for r in W.largest_roots(product(roots), 1)] == [found[0].low]


def fit_of(rows):
    kept, width = [], 0
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(64 * float(np.float32(c))) for c in v]))
            width = max(width, len(v))
    kept = [(i, tuple(v + [0] * (width - len(v)))) for i, v in kept]
    return kept, sorted({v for _, v in kept}), width


def check(rows, got, components=16):
    kept, fit, width = fit_of(rows)
    n = len(fit)
    x = np.array(fit, object).reshape(n, width)
    s = x.sum(axis=0)
    m = n * (x.T @ x) - np.outer(s, s)
    values, vectors = np.linalg.eigh(m.astype(float))
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(m))
    k = min(components, int((values > 1e-9 * trace).sum()))
    table = defaultdict(list)
    for r in got:
        table[r.vec_id].append(r)
    assert len(got) == k * len(kept)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9
    deviations = defaultdict(set)
    for i, v in kept:
        deviations[i].add(int(sum((n * a - b) ** 2 for a, b in zip(v, s))))
    for r in got:
        assert r.n == n and r.deviation in deviations[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
    alone = [j for j in range(k) if all(abs(values[j] - values[i]) > 1e-6 * trace for i in range(len(values)) if i != j)]
    ids = [i for i, _ in kept if [a for a, _ in kept].count(i) == 1]
    where = dict(kept)
    mine = np.array([[next(r.whitened for r in table[i] if r.component == j + 1) for j in range(k)] for i in ids])
    theirs = (np.array([where[i] for i in ids], float) - s.astype(float) / n) @ vectors[:, :k] / np.sqrt(values[:k] / n**2)
    for j in alone:
        sign = np.sign(mine[:, j] @ theirs[:, j])
        assert np.allclose(mine[:, j], sign * theirs[:, j], atol=1e-6)
    return mine


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)


ODD = [
    (5001, None), (5002, []), (5003, [0.0] * 24), (5004, [NAN] + [1.0] * 23), (5005, [INF] * 24),
    (5006, [None] + [1.0] * 23), (5007, [1.0, 2.0]), (None, [0.25] * 24), (5008, [0.5, 0.25] * 12), (5008, [0.5, 0.25] * 12),
]


def test_whitened_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24)) * np.linspace(2, 0.2, 24) + 3
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(1000 + i, x[5].tolist()) for i in range(200)] + ODD
    extra = frame(spark, rows).withColumns({"vector": F.lit(1), "x": F.lit("y"), "n": F.lit(None), "component": F.lit(2)})
    check(rows, W.whiten(extra).collect())


def test_small_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check(rows, W.whiten(table).collect())


def test_equal_eigenvalues_and_low_rank(spark):
    # eight points of a cross in four of six dimensions: one eigenvalue, four times
    rows = [(2 * i + b, [(1.0 - 2 * b) * (j == i) for j in range(6)]) for i in range(4) for b in (0, 1)]
    got = W.whiten(frame(spark, rows)).collect()
    mine = check(rows, got)
    assert mine.shape[1] == 4
    assert np.allclose(mine.T @ mine / 8, np.eye(4), atol=1e-12)
    assert len(W.whiten(frame(spark, rows), components=3).collect()) == 8 * 3


def test_no_components(spark):
    for rows in ([], [(1, [1.0, 2.0])] * 5, [(1, None), (2, [])]):
        got = W.whiten(frame(spark, rows))
        assert got.collect() == [] and len(got.columns) == 7


def test_exact_sums_of_large_numbers(spark):
    rows = [(i, [float(2**40 + i * 2**20), float(i), -float(2**50)]) for i in range(50)]
    fit = W.fit_list(frame(spark, rows), "embedding")
    s = W.scatter(fit)
    x = np.array([[int(64 * np.float32(c)) for c in v] for _, v in rows], object)
    x = np.array(sorted({tuple(v) for v in x.tolist()}), object)
    n, t = len(x), x.sum(axis=0)
    assert s.n == n and list(s.sums) == t.tolist()
    assert [list(r) for r in s.matrix] == (n * (x.T @ x) - np.outer(t, t)).tolist()
