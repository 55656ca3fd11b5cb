"""Whitening against a dense eigensolver and whole-number arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from topicforge.llm import feast, queries, whitening

R = np.random.default_rng(3)


def covariances():
    wide = R.standard_normal((900, 10)) @ R.standard_normal((10, 64)) * 300 + R.standard_normal((900, 64))
    yield np.cov(R.standard_normal((5000, 64)).T * 300, bias=True)   # no gap anywhere
    yield np.cov(wide.T, bias=True)                                  # a large gap
    yield np.cov((R.standard_normal((50, 3)) @ R.standard_normal((3, 40))).T, bias=True)  # rank 3
    yield np.diag(10.0 ** -np.arange(12))
    yield np.diag([5, 5, 5, 3, 3, 2, 2, 2, 2, 2, 1.0])               # ties across the eighth
    yield np.eye(9)
    yield np.array([[4.0]])
    yield np.array([[2.0, 1.0], [1.0, 2.0]]) * 1e200
    yield np.zeros((5, 5))


@pytest.mark.parametrize("covariance", list(covariances()))
def test_contour_finds_the_largest_pairs(covariance):
    values, vectors = feast.largest_pairs(covariance, 8)
    true = np.linalg.eigvalsh(covariance)[::-1]
    positive = int((true > 1e-12 * true[0]).sum()) if true[0] else 0
    assert len(values) == min(8, positive)
    if len(values):
        assert np.allclose(values, true[:len(values)], rtol=1e-13, atol=1e-13 * true[0])
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
        assert np.abs(covariance @ vectors - vectors * values).max() <= 1e-12 * true[0]


def test_inertia_counts():
    for _ in range(300):
        d = R.integers(1, 9)
        a = R.integers(-2, 3, (d, d)).astype(float)
        a = a + a.T
        shift = R.standard_normal()
        assert feast.Inertia(a).above(shift) == (np.linalg.eigvalsh(a) > shift).sum()


def expected(rows, components=8):
    """Exact sums, dense eigenpairs; one fit list."""
    x = [[math.floor(1024 * Fraction(c)) + 100000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, deviation, centred @ vectors / np.sqrt(values), values / np.trace(covariance)


def compare(got, rows):
    n, deviation, white, explained = expected(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(by, key=str) == sorted((i for i, _ in rows), key=str)
    sign = {}
    for (i, _), d, w in zip(rows, deviation, white):
        assert sorted(by[i]) == list(range(1, white.shape[1] + 1))
        for c, r in by[i].items():
            assert (r.n, int(r.deviation)) == (n, d)
            assert abs(r.explained - explained[c - 1]) <= 1e-12
            assert r.identity_error <= 1e-9
            sign.setdefault(c, 1 if r.whitened * w[c - 1] >= 0 else -1)
            assert abs(r.whitened - sign[c] * w[c - 1]) <= 1e-7


def test_rows(spark):
    stretch = np.linspace(1, 3, 12)
    rows = [(i, [float(c) for c in R.standard_normal(12) * stretch]) for i in range(300)]
    rows += [(900, [0.0] * 12), (901, list(rows[0][1]))]
    odd = [(902, None), (903, [math.nan] + [0.0] * 11), (904, [math.inf] + [0.0] * 11), (905, [None] + [0.0] * 11),
           (906, [1e300] + [0.0] * 11), (907, [])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id bigint, embedding array<double>, n int")
    compare(whitening.whiten(frame.repartition(5)).collect(), rows)
    assert whitening.whiten(frame.limit(0)).count() == 0


def test_each_dimension_is_a_fit_list(spark):
    first = [(i, [float(c) for c in R.standard_normal(5)]) for i in range(60)]
    second = [(i, [float(c) * 2 ** 45 for c in R.standard_normal(3)]) for i in range(100, 140)]  # beyond 64-bit squares
    frame = spark.createDataFrame(first + second + [(500, [1.0])], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(frame).collect()
    compare([r for r in got if r.vec_id < 100], first)
    n, deviation, white, _ = expected(second)
    rows = {(r.vec_id, r.component): r for r in got if r.vec_id >= 100}
    assert len(rows) == 40 * 3
    for (i, _), d, w in zip(second, deviation, white):
        assert rows[i, 1].deviation == d if d < 10 ** 38 else rows[i, 1].deviation is None
        assert abs(abs(rows[i, 1].whitened) - abs(w[0])) <= 1e-7


def test_equal_and_repeated_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(frame).count() == 0
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0])], "vec_id bigint, embedding array<float>")
    got = sorted((r.vec_id or 0, r.component, abs(round(r.whitened, 6))) for r in whitening.whiten(frame).collect())
    assert got == [(0, 1, 1.414214), (1, 1, 0.707107), (1, 1, 0.707107)]


def test_query(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    compare(queries.op13_contour_whitening(spark, small).collect(), rows)
