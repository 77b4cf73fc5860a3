import random

import pytest
from pyspark.sql import functions as F

from crossfade.operators import ranking as R
from crossfade.operators.rerank import rerank_multi_objective


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_track_features(spark):
    catalog = spark.createDataFrame(
        [(1, 7, 70, 1), (2, 7, 71, 1), (3, 8, None, 3)],
        "track_id long, genre_id long, artist_id long, track_group_id long",
    )
    events = spark.createDataFrame(
        [(1, 1, 3), (2, 1, 1), (1, 2, 4), (1, 3, 2), (1, 9, 16)],
        "user_id long, track_id long, listen_count long",
    )
    # track 9 is not catalogued: its 16 listens form the null groups and set the maximum
    assert rows(R.track_features(catalog, events), "*") == [
        (1, 8 / 16, 4 / 18, 1.0), (2, 8 / 16, 4 / 18, 1.0), (3, 2 / 16, 0.0, 0.5),
    ]


def test_candidates_labels_and_negatives(spark):
    als = spark.createDataFrame([(1, 10, 0.5), (2, 11, 0.2), (3, 10, 0.1)], "user_id long, track_id long, als_score double")
    top = spark.createDataFrame([(10, 8), (12, 4)], "track_id long, popularity_score long")
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    merged = R.merge_candidates(als, R.popular_candidates(users, top), users)
    assert rows(merged, "*") == [
        (1, 10, 0.5, 1.0), (1, 12, 0.0, 0.5), (2, 10, 0.0, 1.0), (2, 11, 0.2, 0.0), (2, 12, 0.0, 0.5),
    ]
    events = spark.createDataFrame([(2, 12), (2, 12), (5, 10)], "user_id long, track_id long")
    labelled = R.add_labels(merged, events)
    assert rows(labelled.filter("target = 1"), "user_id", "track_id") == [(2, 12)]
    positive = R.users_with_positive(labelled)
    assert {r.user_id for r in positive.collect()} == {2}
    assert R.sample_negatives(positive, 1).count() == 2
    assert R.sample_negatives(labelled, 4).count() == 3


def test_sample_negatives_of_a_hot_user(spark, monkeypatch):
    import hashlib

    pairs = [(1, i, int(i < 40)) for i in range(900)] + [(2, i, int(i == 0)) for i in range(9)] + [(3, 1, 0)]
    df = spark.createDataFrame(pairs, "user_id long, track_id long, target int")

    def sample(user, n):
        mine = [t for u, t, y in pairs if u == user and not y]
        return sorted(sorted(mine, key=lambda t: hashlib.md5(f"{user}:{t}:42".encode()).hexdigest())[:n])

    for slice_rows in (R._SAMPLE_SLICE, 50):
        monkeypatch.setattr(R, "_SAMPLE_SLICE", slice_rows)
        found = R.sample_negatives(df, 4)
        negatives = rows(found.filter("target = 0"), "user_id", "track_id")
        assert [t for u, t in negatives if u == 1] == sample(1, 160)
        assert [t for u, t in negatives if u == 2] == sample(2, 4)
        assert [t for u, t in negatives if u == 3] == []
        assert found.filter("target = 1").count() == 41


@pytest.mark.parametrize("seed", [1, 2])
def test_candidate_lists_equal_rows(spark, seed):
    rng = random.Random(seed)
    personal = spark.createDataFrame(
        [(u, t, rng.random(), k) for u in range(40) for k, t in enumerate(rng.sample(range(60), rng.randint(1, 6)), 1)],
        "user_id long, track_id long, score float, rank int",
    )
    top = spark.createDataFrame([(t, rng.randint(1, 50)) for t in range(0, 60, 2)], "track_id long, popularity_score long")
    heard = [(0 if rng.random() < 0.4 else rng.randint(0, 45), rng.randint(0, 70)) for _ in range(400)]
    events = spark.createDataFrame(heard, "user_id long, track_id long")
    lists = R.label_lists(R.candidate_lists(personal, top, 20), events)
    users = personal.select("user_id")
    plain = R.add_labels(R.merge_candidates(R.als_candidates(personal), R.popular_candidates(users, top, 20), users), events)
    cols = ["user_id", "track_id", "als_score", "popularity_score", "target"]
    assert dict(R.explode_lists(lists).dtypes) == dict(plain.dtypes)
    assert rows(R.explode_lists(lists), *cols) == rows(plain, *cols)
    positive = R.explode_lists(R.lists_with_positive(lists))
    assert rows(positive, *cols) == rows(R.users_with_positive(plain), *cols)
    assert rows(R.explode_lists(R.sample_lists(lists, 2, 7)), *cols) == rows(R.sample_negatives(plain, 2, 7), *cols)


def test_candidate_lists_of_nothing(spark):
    personal = spark.createDataFrame([(1, 5, 0.5)], "user_id long, track_id long, score double")
    top = spark.createDataFrame([], "track_id long, popularity_score long")
    events = spark.createDataFrame([], "user_id long, track_id long")
    assert rows(R.explode_lists(R.candidate_lists(personal, top)), "*") == [(1, 5, 0.5, 0.0)]
    lists = R.label_lists(R.candidate_lists(personal, top), events)
    assert rows(R.explode_lists(lists), "target") == [(0,)] and R.sample_lists(lists).count() == 0
    assert R.candidate_lists(personal.limit(0), top).count() == 0


def greedy(recs, popularity, heard, genres, n, wd=0.3, wp=0.1, wn=0.2):
    """The definition, one user, round by round."""
    top = max(popularity.values())
    left = {}
    for track, score in recs:
        if track not in heard:
            left[track] = (1 - wd - wp - wn) * score + wd + wp * popularity.get(track, 0) / top + wn
    seen, out = set(), []
    while left and len(out) < n:
        for track in left:
            if genres.get(track) not in seen:
                left[track] += wd
        best = min(left, key=lambda t: (-left[t], t))
        out.append((best, round(left.pop(best), 9)))
        if genres.get(best) is not None:
            seen.add(genres[best])
    return out


@pytest.mark.parametrize("n", [1, 4, 10])
def test_rerank_equals_the_greedy_loop(spark, n):
    random.seed(n)
    tracks = range(80)
    genres = {t: random.choice([None, 1, 2, 3, 4]) for t in tracks if t % 9}
    popularity = {t: random.randint(1, 50) for t in tracks if t % 4}
    recs = {u: [(t, random.random()) for t in random.sample(tracks, 60 if u == 0 else 1 + u)] for u in range(12)}
    heard = {u: set(random.sample(tracks, 10)) for u in recs}
    found = rerank_multi_objective(
        spark.createDataFrame([(u, t, s) for u, r in recs.items() for t, s in r], "user_id long, track_id long, score double"),
        spark.createDataFrame(list(popularity.items()), "track_id long, popularity_score long"),
        spark.createDataFrame([(u, t) for u, h in heard.items() for t in h], "user_id long, track_id long"),
        spark.createDataFrame(list(genres.items()), "track_id long, genre_id long"),
        n,
    )
    lists = {}
    for r in found.orderBy("user_id", "rank").collect():
        lists.setdefault(r.user_id, []).append((r.track_id, round(r.score, 9)))
    expected = {u: greedy(r, popularity, heard[u], genres, n) for u, r in recs.items()}
    assert lists == {u: r for u, r in expected.items() if r}


def test_ranker_round_trip(spark, folder):
    random.seed(5)
    data = []
    for user in range(40):
        for track in range(12):
            als = random.random()
            data.append((user, track, als, random.random(), int(als > 0.6)))
    train = spark.createDataFrame(
        data, "user_id long, track_id long, als_score double, popularity_score double, target int"
    )
    model = R.fit_ranker(train, ["als_score", "popularity_score"], iterations=5)
    R.save_ranker(model, f"{folder}/ranker")
    loaded = R.load_ranker(f"{folder}/ranker")
    importance = R.feature_importance(spark, loaded).collect()
    assert importance[0].feature == "als_score"
    assert abs(sum(r.importance for r in importance) - 100) < 1e-6
    ranked = R.predict_and_rank(loaded, train)
    assert ranked.filter("score < 0 or score > 1").count() == 0
    best = ranked.filter("rank = 1")
    assert best.count() == 40 and best.filter("target = 0").count() <= 2
    assert R.top_k_per_user(ranked, 3).count() == 120
    # a feature the table lacks counts as 0
    assert R.predict(loaded, train.drop("popularity_score")).count() == 480


def test_rank_with_model_needs_both_sources(spark):
    rows_ = [(u, t, 0.1 * t, 0.2 * t, 0.0, 0.0, 0.0, t % 2) for u in range(5) for t in range(6)]
    train = spark.createDataFrame(
        rows_, "user_id long, track_id long, " + ", ".join(f"{f} double" for f in R.FEATURES) + ", target int"
    )
    model = R.fit_ranker(train, iterations=2)
    als = train.filter("user_id < 3").select("user_id", "track_id", "als_score")
    popular = train.filter("user_id > 0").select("user_id", "track_id", "popularity_score")
    catalog = spark.createDataFrame([(t, 1, 1, t) for t in range(6)], "track_id long, genre_id long, artist_id long, track_group_id long")
    events = train.select("user_id", "track_id", F.lit(1).alias("listen_count"))
    found = R.rank_with_model(model, als, popular, catalog, events, 4)
    assert {r.user_id for r in found.collect()} == {1, 2}
    assert found.count() == 8


def test_top_of_lists_equals_ranked_rows_without_a_shuffle(spark):
    rng = random.Random(4)
    personal = spark.createDataFrame(
        [(u, t, rng.random(), k) for u in range(20) for k, t in enumerate(rng.sample(range(40), 5), 1)],
        "user_id long, track_id long, score float, rank int",
    )
    top = spark.createDataFrame([(t, rng.randint(1, 4)) for t in range(0, 40, 2)], "track_id long, popularity_score long")
    lists = R.candidate_lists(personal, top, 20)
    ranked = R.top_k_per_user(R.rank_by_score(R.explode_lists(lists), "popularity_score"), 7)
    found = R.top_of_lists(lists, "popularity_score", 7)
    assert dict(found.dtypes) == dict(ranked.dtypes) and rows(found, *ranked.columns) == rows(ranked, *ranked.columns)
    assert rows(R.top_of_lists(lists, "popularity_score", 99), "*") != rows(found, "*")
    plan = R.top_of_lists(R.candidate_lists(personal, top, 20), "popularity_score", 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_rank_all_equals_scoring_every_candidate_without_a_row_for_each(spark):
    rng = random.Random(8)
    personal = spark.createDataFrame(
        [(u, t, rng.random(), k) for u in range(30) for k, t in enumerate(rng.sample(range(50), rng.randint(1, 6)), 1)],
        "user_id long, track_id long, score float, rank int",
    )
    top = spark.createDataFrame([(t, rng.randint(1, 9)) for t in range(0, 50, 2)], "track_id long, popularity_score long")
    catalog = spark.createDataFrame(
        [(t, t % 3, t % 7, t // 2) for t in range(45)], "track_id long, genre_id long, artist_id long, track_group_id long"
    )
    events = spark.createDataFrame(
        [(rng.randint(0, 35), rng.randint(0, 49), rng.randint(1, 5)) for _ in range(300)], "user_id long, track_id long, listen_count long"
    )
    train = R.training_rows(personal, top, R.track_features(catalog, events), events)
    model = R.fit_ranker(train, iterations=4)
    lists = R.label_lists(R.candidate_lists(personal, top, 20), events)
    plain = R.add_track_features(R.explode_lists(lists), R.track_features(catalog, events))
    for k in (3, 8, 40):
        expected = R.top_k_per_user(R.predict_and_rank(model, plain), k)
        found = R.rank_all(model, personal, top, catalog, events, events, k, 20)
        assert found.dtypes == expected.dtypes and rows(found, "*") == rows(expected, "*")
    found = R.rank_all(model, personal, top.limit(0), catalog, events, events, 3)
    assert found.count() == sum(min(r["count"], 3) for r in personal.groupBy("user_id").count().collect())
    plan = R.rank_all(model, personal, top, catalog, events, events)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_the_ranker_learns_from_the_sampled_users_lists_alone(spark, folder, monkeypatch):
    from crossfade.operators import als
    from crossfade.plans.stages import Parameters, Stages

    rng = random.Random(3)
    pairs = sorted({(u, rng.randint(0, 11)) for u in range(30) for _ in range(5)} | {(30, t) for t in range(12)})
    events = spark.createDataFrame([(u, t, 1) for u, t in pairs], "user_id long, track_id long, listen_count long")
    users = spark.createDataFrame([(u, u) for u in range(32)], "user_id long, user_idx long")
    items = spark.createDataFrame([(t, t) for t in range(12)], "track_id long, item_idx long")
    model = als.fit_als(events.toDF("user_idx", "item_idx", "weight"), factors=4, iterations=2, blocks=2)
    every = als.recommend_als(model, users, items, events, 5)
    listed = als.listed_users(model, users, items, events)
    # user 30 has heard all, user 31 has no factors
    assert rows(listed, "user_id") == rows(every.select("user_id").distinct(), "user_id") == [(u,) for u in range(30)]

    names = ("user_encoder", "item_encoder", "train_events", "als_model")
    for name, value in zip(names, (users, items, events, model)):
        monkeypatch.setattr(Stages, name, value)
    stages = Stages(spark, folder, events, events, events, Parameters(sample_users=7, n_recs=5))
    some = R.sample_keys(every, "user_id", 7, 42)
    assert rows(stages._personal_of_sample(), "*") == rows(every.join(some, "user_id", "left_semi"), "*")
    assert stages.record["tables"] == []


def test_candidate_lists_build_no_map_and_no_filter_for_users_who_own_no_top_track(spark):
    rows = [(1, 10, 0.5), (1, 99, 0.25), (2, 99, 0.2), (3, None, 0.1), (3, 11, 0.3), (None, 12, 0.4)]
    personal = spark.createDataFrame(rows, "user_id long, track_id long, score double")
    top = spark.createDataFrame([(10, 4.0), (11, 2.0), (12, 1.0)], "track_id long, popularity_score double")
    lists = R.candidate_lists(personal, top)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "map_from_arrays" not in plan and "CASE WHEN _meets" in plan
    found = {r.user_id: sorted((c.track_id or 0, c.als_score, c.popularity_score) for c in r.candidates) for r in lists.collect()}
    assert found == {
        1: [(10, 0.5, 1.0), (11, 0.0, 0.5), (12, 0.0, 0.25), (99, 0.25, 0.0)],
        2: [(10, 0.0, 1.0), (11, 0.0, 0.5), (12, 0.0, 0.25), (99, 0.2, 0.0)],
        3: [(0, 0.1, 0.0), (11, 0.3, 0.5)],  # with a null own track no other is known to be new
        None: [(10, 0.0, 1.0), (11, 0.0, 0.5), (12, 0.4, 0.25)],
    }
    none = R.candidate_lists(personal, top.limit(0)).where("user_id = 2").first()
    assert [tuple(c) for c in none.candidates] == [(99, 0.2, 0.0)]


def test_sample_of_rows_writes_only_users_with_a_positive(spark, monkeypatch):
    from types import SimpleNamespace

    from crossfade.plans import registry

    personal = spark.createDataFrame([(1, 10, 0.5), (2, 20, 0.2), (2, 21, 0.1)], "user_id long, track_id long, score double")
    top = spark.createDataFrame([(30, 4.0), (31, 2.0)], "track_id long, popularity_score double")
    events = spark.createDataFrame([(1, 99), (2, 30)], "user_id long, track_id long")
    written, real = [], registry.tables.materialize
    monkeypatch.setattr(registry, "_personal", lambda *args: personal)
    monkeypatch.setattr(registry.tables, "materialize", lambda df: written.append(real(df)) or written[-1])
    found = registry.sample_negatives_of_rows(SimpleNamespace(top_popular=top, test_events=events), spark, "")
    assert {r.user_id for r in written[0].collect()} == {2}
    assert sorted((r.track_id, r.target) for r in found.collect()) == [(20, 0), (21, 0), (30, 1), (31, 0)]
