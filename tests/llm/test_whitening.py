"""Whitening against numpy's own decomposition, and its numeric parts alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import bidiagonal, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, n int, part int, r binary"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, "a", 1, 2, b"z") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def expected(vectors, k):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, (x - sums / n) @ basis / np.sqrt(values), values / np.trace(np.cov(fit.T, bias=True))


def test_matches_a_covariance(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((700, 24)) @ rng.standard_normal((24, 24)) / 6).tolist()
    vectors += vectors[:50] + [vectors[3]] * 300
    rows = whitening.whiten(table(spark, vectors).repartition(40)).collect()
    assert len(rows) == 16 * len(vectors)
    n, deviation, whitened, explained = expected(vectors, 16)
    found = np.zeros_like(whitened)
    for r in rows:
        found[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert (r["n"], r["deviation"]) == (n, deviation[r["vec_id"]])
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-9
    signs = np.sign((found * whitened).sum(axis=0))
    assert np.abs(found * signs - whitened).max() < 1e-8


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 0.25, 1.0], [0.125, -0.5, 2.0], [0.0, 0.0, 0.0], [3.0, -0.25, 0.5]]
    odd = [None, [], [nan, 0.0, 1.0], [1.0, inf, 0.0], [1.0, None, 0.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    rows = whitening.whiten(table(spark, good + odd + good[:1], [None, *range(10), 70])).collect()
    assert {r["vec_id"] for r in rows} == {None, 0, 1, 2, 70}
    assert {r["component"] for r in rows} == {1, 2, 3} and len(rows) == 15
    assert {r["n"] for r in rows} == {4}
    null, last = ({r["component"]: r["whitened"] for r in rows if r["vec_id"] == i} for i in (None, 70))
    assert null == last
    flat = table(spark, [[v, 2 * v, 1.0] for v in (0.5, 1.0, 2.0, 4.0)])
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}  # one direction of variance
    assert whitening.whiten(table(spark, good[:1] * 5)).collect() == []
    assert whitening.whiten(table(spark, good).where("1 = 0")).collect() == []


def test_deviations_beyond_a_long():
    mean = whitening.Centre(3, [10, 11])
    x = np.array([[5, 1], [1 << 40, 1 << 52], [3, 4]])
    wide = mean.deviations(x).to_pylist()
    assert wide == [(15 - 10) ** 2 + (3 - 11) ** 2, None, (9 - 10) ** 2 + (12 - 11) ** 2]
    assert mean.deviations(x[[0, 2]]).to_pylist() == [wide[0], wide[2]]


def test_triangles_are_merged_in_rounds(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-99, 99, (600, 5))
    fit = spark.createDataFrame([(r,) for r in x.tolist()], "x array<long>").repartition(60)
    mean = whitening.centre(fit)
    assert mean.m.tolist() == (x.sum(axis=0) // 600).tolist()
    r = whitening.triangle(fit, mean)
    centred = x - x.mean(axis=0)
    assert np.allclose(r.T @ r, centred.T @ centred, rtol=1e-12, atol=1e-7)


CHANCE = np.random.default_rng(1)
MATRICES = {
    "plain": CHANCE.standard_normal((300, 40)),
    "graded": CHANCE.standard_normal((300, 40)) @ np.diag(10.0 ** -np.arange(40).clip(0, 12)),
    "few rows": CHANCE.standard_normal((9, 20)),
    "equal values": np.linalg.qr(CHANCE.standard_normal((50, 20)))[0] * 3,
    "three values": np.linalg.qr(CHANCE.standard_normal((50, 20)))[0] @ np.diag([5.0] * 7 + [3.0] * 7 + [1.0] * 6),
    "diagonal": np.diag([4.0, 4, 4, 2, 2, 0, 0, 0]),
    "close pairs": np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
    "one column": CHANCE.standard_normal((4, 1)),
    "one row": np.ones((1, 5)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_directions(name):
    m = MATRICES[name]
    r = np.linalg.qr(np.vstack([m, np.zeros((m.shape[1],) * 2)]), mode="r")
    values, vectors = bidiagonal.leading_directions(r, 16)
    k = len(values)
    assert k == min(16, np.linalg.matrix_rank(m))
    assert np.abs(values / np.linalg.svd(m, compute_uv=False)[:k] ** 2 - 1).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-10
    assert np.abs(m.T @ (m @ vectors) - vectors * values).max() < 1e-12 * values[0]


def test_small_singular_values_keep_their_digits():
    b = np.diag(10.0 ** -np.arange(0, 24, 2)) + np.diag(10.0 ** -np.arange(1, 23, 2), 1)
    values = bidiagonal.squared_singular_values(np.diag(b), np.diag(b, 1))
    assert values[0] > 0
    # The determinant is the product of all values.
    assert np.prod(values) ** 0.5 == pytest.approx(np.prod(np.diag(b)), rel=1e-12)
