import numpy as np
import pytest
from pyspark.ml.recommendation import ALS

from crossfade.operators import als
from crossfade.operators import normal_equations as N


def _dense(factors, gram, link, weight, alpha, regularization):
    own, weight = factors[link].astype(float), weight.astype(float)
    extra, positive = alpha * np.abs(weight), weight > 0
    left = gram + (own * extra[:, None]).T @ own + regularization * positive.sum() * np.eye(len(gram))
    return np.linalg.solve(left, own.T @ np.where(positive, 1 + extra, 0.0))


@pytest.mark.parametrize("entries", [1 << 17, 64])
@pytest.mark.parametrize("regularization", [0.01, 0.0])
def test_rows_of_any_length_are_solved_exactly(monkeypatch, entries, regularization):
    monkeypatch.setattr(N, "_ENTRIES", entries)
    rng = np.random.default_rng(1)
    factors = rng.normal(size=(60, 8)).astype(np.float32)
    gram = N._gram(factors)
    counts = np.array([1, 1, 2, 5, 7, 8, 8, 30, 55])
    links = np.concatenate([rng.choice(60, n, replace=n > 20) for n in counts]).astype(np.int32)
    weights = rng.integers(-1, 6, counts.sum()).astype(np.float32)
    weights[0], weights[1] = -2, 3  # the first row has no positive rating
    found = N.solve_rows(factors, gram, counts, links, weights, 2.0, regularization)
    first = np.concatenate([[0], np.cumsum(counts)])
    assert not found[0].any()
    for i in range(1, len(counts)):
        some = slice(first[i], first[i + 1])
        expected = _dense(factors, gram, links[some], weights[some], 2.0, regularization)
        np.testing.assert_allclose(found[i], expected, rtol=1e-5, atol=1e-6)


def test_short_rows_never_meet_a_matrix_of_the_rank(monkeypatch):
    solved, real = [], np.linalg.solve
    monkeypatch.setattr(np.linalg, "solve", lambda a, b: solved.append(a.shape) or real(a, b))
    factors = np.random.default_rng(2).normal(size=(40, 64)).astype(np.float32)
    links, weights = np.arange(40, dtype=np.int32), np.ones(40, np.float32)
    N.solve_rows(factors, N._gram(factors), np.full(10, 4), links, weights, 1.0, 0.01)
    assert solved == [(10, 4, 4)]


def test_factors_are_those_of_mllib(spark, monkeypatch):
    monkeypatch.setattr(N, "_SENT_BYTES", 200)  # more than one batch
    rng = np.random.default_rng(3)
    rows = [(int(u), int(i), float(w)) for u, i, w in zip(rng.integers(0, 50, 400), rng.zipf(1.5, 400) % 40, rng.integers(-1, 7, 400))]
    matrix = spark.createDataFrame(rows, "user_idx int, item_idx int, weight float")  # pairs come more than once
    found = als.fit_als(matrix, factors=6, iterations=4, alpha=2.0, blocks=3)
    expected = ALS(
        rank=6, maxIter=4, regParam=0.01, alpha=2.0, implicitPrefs=True, seed=42, numUserBlocks=3, numItemBlocks=3,
        userCol="user_idx", itemCol="item_idx", ratingCol="weight",
    ).fit(matrix)
    assert found.rank == 6
    for side in ("userFactors", "itemFactors"):
        a, b = (dict(map(tuple, getattr(model, side).collect())) for model in (found, expected))
        assert a.keys() == b.keys() and getattr(found, side).dtypes == getattr(expected, side).dtypes
        for key in a:
            np.testing.assert_allclose(a[key], b[key], rtol=1e-3, atol=1e-5)
