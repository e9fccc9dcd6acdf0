"""Whitening against the covariance matrix solved whole."""

import math
import os
from fractions import Fraction

import numpy as np
import pytest

from strataloom.llm import whitening
from strataloom.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def held(rows, found, k=8):
    """Check all rows of `found` against numpy's eigenvectors; rows are (vec_id, vector)."""
    x = np.floor(1024 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    centred = np.array([[float(Fraction(int(n * c - s), n)) for c, s in zip(row, total)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, x.shape[1])
    got = {(r.vec_id, r.component): r for r in found}
    assert len(got) == len(found) == n * k
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    mine = np.array([[got[i, c + 1].whitened for c in range(k)] for i, _ in rows])
    for c in range(k):
        sign = np.sign(mine[:, c] @ want[:, c])
        assert np.allclose(mine[:, c], sign * want[:, c], atol=1e-8), c
    for i, (vec, _) in enumerate(rows):
        r = got[vec, 1]
        assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], total))
    first = found[0]
    assert abs(got[rows[0][0], 1].explained - values[0] / values.sum()) < 1e-10
    cov = mine.T @ mine / n
    assert first.identity_error < 1e-9 and abs(cov - np.eye(k)).max() < 1e-8


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()]
    held(rows, QUERIES["op12_whitening"](spark, FOLDER).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(5) * [5, 3, 1, 0.5, 0.1]).tolist()) for i in range(400)]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [float("nan")] * 5), (904, [1.0, 2.0, float("inf"), 0.0, 0.0]), (905, [1.0, 2.0]), (906, [float("-inf")] + [0.0] * 4)]
    docs = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows + bad], "vec_id bigint, embedding array<double>, component string, whitened double").repartition(40)
    held(rows, whitening.whiten(docs).collect())
    again = spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [3.0, 2.0])], "vec_id bigint, embedding array<float>")
    found = whitening.whiten(again).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert all(r.whitened is None and r.explained == 0 for r in found if r.component == 2)
    assert sorted(round(r.whitened, 6) for r in found if r.component == 1) in ([-0.707107, -0.707107, 1.414214], [-1.414214, 0.707107, 0.707107])
    one = whitening.whiten(again.where("vec_id is null")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 2
    assert whitening.whiten(again.limit(0)).count() == 0
    assert whitening.whiten(again.limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_numbers_beyond_64_bits():
    x = np.array([[1 << 50, 3], [5, 7]])
    y = whitening.lifted(x, 10**6, x.sum(0))
    assert y[0, 0] == (1 << 50) * 10**6 - (1 << 50) - 5
    assert whitening.deviations(y).to_pylist()[0] is None and whitening.deviations(np.array([[3, 4]])).to_pylist() == [25]


@pytest.mark.parametrize("kind", ["graded", "clustered", "equal", "zeros", "wide", "random", "one"])
def test_solver(kind):
    rng = np.random.default_rng(7)
    d = 1 if kind == "one" else 40
    sizes = {"graded": 10.0 ** -np.arange(d), "clustered": 1 + 1e-12 * np.arange(d), "equal": np.ones(d), "zeros": np.r_[np.ones(5) * 3, np.arange(1, 6), np.zeros(30)]}.get(kind, rng.random(d))
    u, v = (np.linalg.qr(rng.standard_normal((d, d)))[0] for _ in range(2))
    r = np.triu(rng.standard_normal((d, d))) if kind == "random" else np.linalg.qr(u * sizes @ v.T, mode="r")
    r = r[:7] if kind == "wide" else r
    a, b, back = whitening.bidiagonal(np.vstack([r, np.zeros((d - len(r), d))]))
    assert np.allclose(back.T @ back, np.eye(d))
    want = np.linalg.svd(r, compute_uv=False)
    got = np.sqrt(whitening.squared_singular_values(a, b))
    assert np.allclose(got[: len(want)], want, rtol=1e-12, atol=1e-14 * want[0]) and np.allclose(got[len(want) :], 0, atol=1e-13)
    values, vectors = whitening.leading_components(r, 8)
    k = min(8, d)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-10)
    assert np.allclose(r.T @ (r @ vectors), vectors * values, atol=1e-12 * values[0] * d)


def test_values_are_accurate_one_by_one():
    """dqds keeps the digits of the smallest values, unlike a solver that forms the product."""
    a, b = np.array([1.0, 1e-5, 1e-10]), np.array([1e-3, 1e-9])
    product = math.prod(whitening.squared_singular_values(a, b))
    assert abs(product / (a.prod() ** 2) - 1) < 1e-13
