import math

import numpy as np
import pytest

from crossfade.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, whitened int, dim int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "mine", 2, 3) for i, v in vectors], SCHEMA)


def made(n, size, seed=0, scale=None):
    rng = np.random.default_rng(seed)
    scale = np.linspace(3, 0.2, size) if scale is None else scale
    turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
    data = (rng.normal(size=(n, size)) * scale) @ turn + rng.normal(size=size) * 5
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(data)]


def kept(vectors):
    fine = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [i for i, _ in fine], np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in fine], object)


def check(found, vectors, components=32):
    ids, x = kept(vectors)
    n, sums = len(x), x.sum(axis=0)
    y = np.array(n * x - sums, float) / n
    v = y.T @ y / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(components, int((values > values[0] * 1e-11).sum()))
    rows = found.collect()
    assert len(rows) == n * k and {r.n for r in rows} == {n}
    out = np.zeros((n, k))
    place = {i: at for at, i in enumerate(ids)}
    deviations = [sum(int(n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    for r in rows:
        at = place[r.vec_id]
        out[at, r.component - 1] = r.whitened
        assert r.deviation == deviations[at]
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        assert r.identity_error <= 1e-8
    expected = y @ basis[:, :k] / np.sqrt(values[:k])
    expected *= np.sign((expected * out).sum(axis=0))
    assert np.abs(out - expected).max() < 1e-6
    assert np.abs(out.T @ out / n - np.eye(k)).max() < 1e-8


@pytest.mark.parametrize("size, parts", [(6, 1), (40, 7)])
def test_equals_eigenvectors(spark, size, parts):
    vectors = made(400, size)
    vectors += [(900, None), (901, [None] * size), (902, [math.nan] * size), (903, [math.inf] * size), (904, [1.0, None] + [0.0] * (size - 2))]
    vectors += [(None, vectors[0][1]), (7, vectors[0][1])]
    vectors = [(i if i != 7 else 7000 + k, v) for k, (i, v) in enumerate(vectors)]
    check(W.whiten(frame(spark, vectors).repartition(parts)), vectors)


def test_dependent_and_constant_dimensions(spark):
    vectors = [(i, [a, 2 * a, 5.0, b]) for i, (a, b) in enumerate(np.random.default_rng(1).integers(-9, 9, (60, 2)).astype(float).tolist())]
    found = W.whiten(frame(spark, vectors))
    assert {r.component for r in found.collect()} == {1, 2}
    check(found, vectors)


def test_nothing_to_whiten(spark):
    same = [(i, [1.0, 2.0]) for i in range(5)]
    for vectors in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], same):
        found = W.whiten(frame(spark, vectors))
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert found.collect() == []


def test_odd_lengths_and_huge_entries_are_dropped(spark):
    vectors = made(50, 3)
    extra = [(100, [1.0]), (101, []), (102, [1e30, 0.0, 0.0]), (103, [-1e38, 0.0, 0.0])]
    check(W.whiten(frame(spark, vectors + extra)), vectors)


def test_large_offset_and_small_spread_keep_their_digits(spark):
    vectors = [(i, [100_000 + a / 64, -50_000 + b / 64, a / 64]) for i, (a, b) in enumerate(np.random.default_rng(2).integers(0, 3, (80, 2)).tolist())]
    found = W.whiten(frame(spark, vectors))
    assert max(r.identity_error for r in found.collect()) < 1e-9


def test_deviation_beyond_long_is_null(spark):
    rows = [(1, [2.0**40]), (2, [-(2.0**40)])] * 3
    found = W.whiten(frame(spark, rows))
    assert {r.deviation for r in found.collect()} == {None}


def test_tied_eigenvalues(spark):
    vectors = [(8 * k + i, [float(c) for c in row]) for k in range(4) for i, row in enumerate(np.vstack([np.eye(4), -np.eye(4)]))]
    rows = W.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in rows} == {1, 2, 3, 4}
    out = np.zeros((32, 4))
    for r in rows:
        out[r.vec_id, r.component - 1] = r.whitened
        assert r.explained == pytest.approx(0.25)
    assert np.allclose(out.T @ out / 32, np.eye(4))


@pytest.mark.parametrize("size", [1, 2, 7, 96])
def test_factor_and_rotation(size):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(3 * size, size)) * np.logspace(0, -5, size)
    a = x.T @ x
    factor = W.pivoted_cholesky(a)
    assert np.abs(factor @ factor.T - a).max() <= 1e-12 * a.max()
    values, vectors = W.principal_components(a)
    assert np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-10)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-5, atol=1e-14 * a.max())


def test_tasks_are_added_in_their_order(spark):
    df = frame(spark, made(300, 5)).repartition(9, "vec_id")
    one, two = (W.whiten(df).orderBy("vec_id", "component").collect() for _ in range(2))
    assert one == two
