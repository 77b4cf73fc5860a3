import numpy as np
import pytest
from pyspark.sql import functions as F

from crossfade.operators import products
from crossfade.operators.als import fit_als, item_vectors, recommend_als
from crossfade.operators.products import top_k_products
from crossfade.operators.similar import similar_items, similar_lookup


def brute_force(queries, items, k, barred=()):
    found = {}
    for q, x in queries.items():
        scores = [(-float(np.dot(x, y)), i) for i, y in items.items() if (q, i) not in barred]
        found[q] = [i for _, i in sorted(scores)[:k]]
    return found


def vectors(spark, table, id_col):
    rows = [(i, [float(x) for x in v]) for i, v in table.items()]
    return spark.createDataFrame(rows, f"{id_col} long, vector array<double>")


def lists(df, key, value):
    out = {}
    for row in df.orderBy(key, "rank").collect():
        out.setdefault(row[key], []).append(row[value])
    return out


@pytest.mark.parametrize("query_rows, item_rows", [(4096, 32768), (7, 5)])
def test_blocks_equal_brute_force(spark, query_rows, item_rows):
    rng = np.random.default_rng(0)
    # whole numbers make exact ties likely; the lowest id must win them
    queries = {i: rng.integers(-2, 3, 4) for i in range(30)}
    items = {2**53 + i: rng.integers(-2, 3, 4) for i in range(40)}
    barred = {(0, i) for i in list(items)[:-2]}  # a query with a very long list
    barred |= {(q, 2**53 + (q * 7) % 40) for q in range(1, 30)} | {(999, 2**53), (3, -1)}
    excluded = spark.createDataFrame(sorted(barred), "query_id long, item_id long")
    found = top_k_products(
        vectors(spark, queries, "query_id"), vectors(spark, items, "item_id"), 5, excluded,
        query_rows, item_rows,
    )
    expected = brute_force(queries, items, 5, barred)
    assert lists(found, "query_id", "item_id") == expected
    assert len(expected[0]) == 2


def test_similar_items_leaves_itself_out(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "track_id long, features array<float>")
    found = similar_items(df, 2)
    assert lists(found, "track_id", "similar_track_id")[1] == [2, 3]
    assert lists(found, "track_id", "similar_track_id")[2] == [1, 3]
    only = similar_items(df, 2, df.filter("track_id = 3"))
    assert lists(only, "track_id", "similar_track_id") == {3: [1, 2]}
    assert [r.similar_track_id for r in similar_lookup(found, 1, 1).collect()] == [2]


def test_hot_group_of_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(i), 1.0, 0.5]) for i in range(60)]
    df = spark.createDataFrame(rows, "track_id long, features array<double>")
    found = lists(similar_items(df, 4), "track_id", "similar_track_id")
    copies = [i for i in range(60) if i % 3 == 0]
    for i in copies:
        assert found[i] == [c for c in copies if c != i][:4]


@pytest.fixture(scope="module")
def model_data(spark):
    rng = np.random.default_rng(1)
    pairs = {(int(u), int(i)) for u, i in zip(rng.integers(0, 25, 200), rng.integers(0, 30, 200))}
    pairs |= {(0, i) for i in range(28)}  # one user has heard nearly everything
    rows = [(u, i, float(1 + (u * i) % 4)) for u, i in sorted(pairs)]
    matrix = spark.createDataFrame(rows, "user_idx int, item_idx int, weight float")
    users = spark.range(26).select((F.col("id") + 100).alias("user_id"), F.col("id").cast("int").alias("user_idx"))
    items = spark.range(30).select((F.col("id") + 500).alias("track_id"), F.col("id").cast("int").alias("item_idx"))
    history = matrix.select((F.col("user_idx") + 100).alias("user_id"), (F.col("item_idx") + 500).alias("track_id"))
    return fit_als(matrix, factors=6, iterations=4), users, items, history


def test_recommend_als_never_repeats_history(model_data):
    model, users, items, history = model_data
    recs = recommend_als(model, users, items, history, 5)
    assert recs.join(history, ["user_id", "track_id"]).count() == 0
    ranks = lists(recs, "user_id", "rank")
    assert all(r == list(range(1, len(r) + 1)) for r in ranks.values())
    assert len(ranks[100]) <= 2 and len(ranks[101]) == 5
    assert 125 not in ranks  # unknown to the model
    assert dict(recs.dtypes) == {"user_id": "bigint", "track_id": "bigint", "score": "float", "rank": "int"}


def test_recommend_als_without_history_equals_mllib(model_data):
    model, users, items, _ = model_data
    expected = {
        row.user_idx + 100: [r.item_idx + 500 for r in row.recommendations]
        for row in model.recommendForAllUsers(5).collect()
    }
    assert lists(recommend_als(model, users, items, None, 5), "user_id", "track_id") == expected
    some = users.filter("user_id in (101, 103)")
    found = lists(recommend_als(model, users, items, None, 5, some), "user_id", "track_id")
    assert found == {u: expected[u] for u in (101, 103)}


def test_item_vectors_feed_similarity(model_data):
    model, _, items, _ = model_data
    found = similar_items(item_vectors(model, items).toDF("track_id", "features"), 3)
    assert found.count() == 3 * model.itemFactors.count()
    assert found.filter("track_id = similar_track_id or abs(similarity_score) > 1.000001").count() == 0


def clustered(n, size, clusters, seed):
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(7).normal(size=(clusters, size))
    rows = centres[rng.integers(0, clusters, n)] + 0.05 * rng.normal(size=(n, size))
    return {i: row for i, row in enumerate(rows * np.exp(0.3 * rng.normal(size=(n, 1))))}


@pytest.mark.parametrize("one_step", [0, 10**6])
def test_bounds_open_few_blocks_and_lose_nothing(spark, monkeypatch, one_step):
    monkeypatch.setattr(products, "ONE_STEP", one_step)
    monkeypatch.setattr(products, "HOME_ROWS", 64)
    queries, items = clustered(300, 12, 25, 1), clustered(1500, 12, 25, 2)
    barred = {(q, i) for q in range(0, 300, 3) for i in range(q % 7, 1500, 5)}
    excluded = spark.createDataFrame(sorted(barred), "query_id long, item_id long")
    found = products.search_blocks(
        vectors(spark, queries, "query_id"), vectors(spark, items, "item_id"), 4, excluded, 20, 30, stripe=3
    )
    assert lists(found.rows, "query_id", "item_id") == brute_force(queries, items, 4, barred)
    pairs = found.pairs.first()
    assert pairs.opened < 0.4 * pairs.query_blocks * pairs.item_blocks


@pytest.mark.parametrize("one_step", [0, 10**6])
def test_copies_in_many_blocks_tie_by_id(spark, monkeypatch, one_step):
    monkeypatch.setattr(products, "ONE_STEP", one_step)
    monkeypatch.setattr(products, "HOME_ROWS", 10)
    rng = np.random.default_rng(3)
    hot = rng.normal(size=9)
    items = {i: hot if i % 3 else rng.normal(size=9) for i in range(200)}
    found = products.search_blocks(None, vectors(spark, items, "item_id"), 6, None, None, 8)
    got = lists(found.rows, "query_id", "item_id")
    copies = [i for i in items if i % 3]
    assert all(got[i] == copies[:6] for i in copies)
    assert {q: set(f) for q, f in got.items() if q % 3 == 0} == {q: set(f) for q, f in brute_force(items, items, 6).items() if q % 3 == 0}


def test_vectors_without_a_product_are_left_out(spark):
    good = {1: [1.0, 0.0], 2: [0.0, 2.0], 3: [1.0, 1.0]}
    rows = [(i, v) for i, v in good.items()] + [(4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, None), (7, [None, 1.0])]
    table = spark.createDataFrame(rows, "item_id long, vector array<double>")
    found = top_k_products(table.withColumnRenamed("item_id", "query_id"), table, 9)
    assert lists(found, "query_id", "item_id") == brute_force(good, good, 9)
    assert top_k_products(None, table.limit(0), 3).collect() == []
    assert top_k_products(table.limit(0).withColumnRenamed("item_id", "query_id"), table, 3).collect() == []


def test_items_that_ask_are_copied_once_a_core(spark):
    rng = np.random.default_rng(5)
    items = {i: rng.normal(size=8) for i in range(3000)}  # without structure: every pair of blocks is opened
    found = products.search_blocks(None, vectors(spark, items, "item_id"), 3, None, None, 32)
    pairs = found.pairs.first()
    assert pairs.item_blocks > 60 and pairs.query_blocks <= 2 * spark.sparkContext.defaultParallelism
    assert lists(found.rows, "query_id", "item_id") == brute_force(items, items, 3)
