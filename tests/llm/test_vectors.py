import numpy as np
import pytest

from crossfade.llm import vectors as V


def brute(rows):
    n = len(rows)
    unit = []
    for _, label, v in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if ok else None)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), low, rows[i][0] is not None and rows[i][0] == low))
    return out


@pytest.mark.parametrize(("block", "links_held"), [(V.BLOCK, V._LINKS_HELD), (16, 20)])
def test_equals_brute_force(spark, monkeypatch, block, links_held):
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "_LINKS_HELD", links_held)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 32))
    rows = []
    for i in range(400):
        v = base[i % 60] + rng.standard_normal(32) * (0.02 if i % 7 else 0.6)
        rows.append((i, int(i % 60 % 3), v.tolist()))
    hot = (base[0] * 2).tolist()
    rows += [(1000 + i, 0, hot) for i in range(60)] + [(1100 + i, 1, (base[1] + rng.standard_normal(32) * 0.01).tolist()) for i in range(60)]
    rows += [(2000, None, hot), (2001, 0, None), (2002, 0, []), (2003, 0, [0.0] * 32), (2004, 0, [None, *hot[1:]]), (2005, 0, [float("nan"), *hot[1:]])]
    rows += [(2006, 0, hot[:16]), (2007, 0, hot[:16]), (1000, 0, hot), (None, 0, hot), (2008, 0, [1e30] * 32), (2009, 0, [1e-30] * 32), (2010, 9, [-0.0, 1.0]), (2011, 9, [0.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, kept string")
    got = sorted(map(tuple, V.near_vectors(df).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_recall_on_random_neighbours(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((2000, 64))
    near = base + rng.standard_normal((2000, 64)) * 0.17
    rows = [(i, 1, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    unit = np.array([r[2] for r in rows], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    total = int((unit @ unit.T >= 0.98).sum()) - len(rows)
    found = sum(r["n_links"] for r in V.near_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect())
    assert total > 1000 and 0.97 * total <= found <= total


@pytest.mark.parametrize(("share", "noise"), [(3, 0.05), (3, 0.12), (1, 0.12)])
def test_recall_in_a_large_group_of_near_copies(spark, share, noise):
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((1500, 64))
    rows[::share] = rows[0] + rng.standard_normal((len(rows[::share]), 64)) * noise
    unit = rows.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    expected = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    df = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(rows)], "vec_id long, label int, embedding array<float>")
    found = np.array([r["n_links"] for r in V.near_vectors(df).orderBy("vec_id").collect()])
    assert (found <= expected).all() and found.sum() >= 0.99 * expected.sum()


def test_no_vectors(spark):
    assert V.near_vectors(spark.createDataFrame([], "vec_id long, label int, embedding array<double>")).count() == 0


@pytest.mark.parametrize(("size", "mean"), [(64, 0.8), (768, 0.8), (64, 0.88)])
def test_recall_in_a_narrow_cone(spark, size, mean):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((1200, size))
    base *= np.sqrt(1 - mean) / np.linalg.norm(base, axis=1, keepdims=True)
    base[:, 0] += np.sqrt(mean)
    noise = rng.standard_normal((1200, size))
    noise *= rng.uniform(0, 0.2, (1200, 1)) / np.linalg.norm(noise, axis=1, keepdims=True)
    rows = np.concatenate([base, base + noise])
    unit = rows.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    total = int((unit @ unit.T >= 0.98).sum()) - len(rows)
    df = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(rows)], "vec_id long, label int, embedding array<float>")
    found = sum(r["n_links"] for r in V.near_vectors(df).collect())
    assert total > 2000 and 0.97 * total <= found <= total


@pytest.mark.parametrize("mean", [0.0, 0.8])
def test_few_pairs_meet(mean):
    rows = np.random.default_rng(4).standard_normal((2000, 64))
    rows *= np.sqrt(1 - mean) / np.linalg.norm(rows, axis=1, keepdims=True)
    rows[:, 0] += np.sqrt(mean)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    order = np.argsort(-(rows @ V._pivots(rows).T), axis=1)[:, : V.NEAREST]
    near = np.zeros((2000, V.PIVOTS))
    np.put_along_axis(near, order, 1, axis=1)
    assert ((near @ near.T >= V.SHARED).mean()) < 0.1


def test_near_pairs_of_lists_equal_all_products():
    rng = np.random.default_rng(6)
    units = rng.standard_normal((700, 3))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    ends = np.repeat([1, 130, 131, 600, 700], [1, 129, 1, 469, 100])
    got = [pair for a, b in V._near_pairs(units, ends, 0.9) for pair in zip(a.tolist(), b.tolist())]
    product = units @ units.T
    assert sorted(got) == [(a, b) for a in range(700) for b in range(a + 1, int(ends[a])) if product[a, b] >= 0.9]
    assert list(V._near_pairs(units[:0], ends[:0], 0.9)) == []
