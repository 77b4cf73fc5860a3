from datetime import date, datetime

import pytest

from crossfade.operators import events as E
from crossfade.operators.popularity import popularity, recommend_popular, top_popular


@pytest.fixture(scope="module")
def interactions(spark):
    rows = [
        (1, 10, 1, datetime(2022, 1, 1, 23, 59)), (1, 10, 2, datetime(2022, 1, 3)),
        (1, 11, 3, datetime(2022, 1, 2)), (2, 10, 4, datetime(2022, 1, 5)),
        (2, 12, 5, datetime(2022, 1, 4)), (3, 11, 1000, datetime(2022, 1, 1)),
        (3, 99, 1, datetime(2022, 1, 1)),
    ]
    return spark.createDataFrame(rows, "user_id long, track_id long, track_seq long, started_at timestamp")


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [(t, f"T{t}", t, 1, 1, 1) for t in (10, 11, 12, 13)]
    return spark.createDataFrame(
        rows,
        "track_id long, track_clean string, track_group_id long, artist_id long, album_id long, genre_id long",
    )


@pytest.fixture(scope="module")
def events(interactions, catalog):
    return E.build_events(interactions, catalog, 0.8).cache()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_build_events(interactions, catalog, events):
    # 7 values, row round(6 * 0.8) = 5 -> 5
    assert E.quantile_threshold(interactions, 0.8).first().threshold == 5.0
    assert rows(events) == [
        (1, 10, 2, date(2022, 1, 3)), (1, 11, 1, date(2022, 1, 2)),
        (2, 10, 1, date(2022, 1, 5)), (2, 12, 1, date(2022, 1, 4)),
    ]


def test_remapped_events(spark, interactions, catalog):
    mapping = spark.createDataFrame(
        [(10, 10), (11, 10), (12, 12), (99, 13)], "track_id long, track_id_canonical long"
    )
    found = rows(E.build_events(interactions, catalog, 0.8, mapping))
    assert found == [
        (1, 10, 3, date(2022, 1, 3)), (2, 10, 1, date(2022, 1, 5)),
        (2, 12, 1, date(2022, 1, 4)), (3, 13, 1, date(2022, 1, 1)),
    ]


def test_split_is_a_partition(events):
    day = E.date_threshold(events, 0.5)
    train, test = E.chrono_split(events, day)
    assert rows(train.unionByName(test)) == rows(events)
    assert day.first().threshold == date(2022, 1, 4)  # row round(1.5) = 2
    assert {r.side: (r.interactions, r.users, r.tracks) for r in E.split_stats(events, day).collect()} == {
        "train": (3, 2, 3), "test": (1, 1, 1),
    }


def test_given_threshold(events):
    assert E.date_threshold(events, explicit="03.01.2022").first().threshold == date(2022, 1, 3)
    assert E.date_threshold(events, 0.0, explicit="2022-01-03").first().threshold == date(2022, 1, 2)


def test_matrix_and_summary(events):
    users = E.encode_labels(events, "user_id", "user_idx")
    items = E.encode_labels(events, "track_id", "item_idx")
    matrix = E.interaction_matrix(events, users, items)
    assert rows(matrix) == [(0, 0, 2.0), (0, 1, 1.0), (1, 0, 1.0), (1, 2, 1.0)]
    summary = E.data_summary(events, matrix, users, items).first()
    assert (summary.n_users, summary.n_tracks, summary.n_interactions) == (2, 3, 4)
    assert summary.total_listens == 5 and summary.avg_listens == 1.25
    assert abs(summary.sparsity - 100 * (1 - 4 / 6)) < 1e-9


def test_popularity_methods(events):
    assert rows(popularity(events)) == [(10, 3), (11, 1), (12, 1)]
    assert rows(popularity(events, "user_count")) == [(10, 2), (11, 1), (12, 1)]
    assert rows(popularity(events, "avg_listens")) == [(10, 1.5), (11, 1.0), (12, 1.0)]
    with pytest.raises(ValueError, match="unknown method"):
        popularity(events, "best")


def test_top_popular_is_ordered_and_safe_to_limit(events, catalog):
    top = top_popular(popularity(events), 2, catalog)
    assert [(r.track_id, r.track_clean) for r in top.collect()] == [(10, "T10"), (11, "T11")]
    assert [r.track_id for r in top.limit(1).collect()] == [10]


def test_recommend_popular_skips_heard_tracks(spark, events):
    users = spark.createDataFrame([(1,), (2,), (9,), (9,)], "user_id long")
    top = top_popular(popularity(events), 3)
    found = rows(recommend_popular(users, events, top, 2).select("user_id", "rank", "track_id"))
    assert found == [(1, 1, 12), (2, 1, 11), (9, 1, 10), (9, 2, 11)]
    # only the n most popular tracks are candidates
    assert rows(recommend_popular(users, events, top, 2, n=1).select("user_id", "track_id")) == [(9, 10)]


def test_recommend_popular_fills_up_heavy_users(spark):
    scores = spark.createDataFrame([(t, 1000 - t // 2) for t in range(300)], "track_id long, popularity_score long")
    heard = [(1, t) for t in range(95)] + [(1, t) for t in (101, 104, 104)] + [(2, t) for t in range(300)] + [(3, 0)]
    history = spark.createDataFrame(heard, "user_id long, track_id long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    found = recommend_popular(users, history, top_popular(scores, 100), 10, scores=scores)
    ranked = [(r.user_id, r.rank, r.track_id, r.popularity_score) for r in found.orderBy("user_id", "rank").collect()]
    mine = [95, 96, 97, 98, 99, 100, 102, 103, 105, 106]
    expected = [(1, i + 1, t, 1000.0 - t // 2) for i, t in enumerate(mine)]
    assert ranked == expected + [(3, i, i, 1000.0 - i // 2) for i in range(1, 11)]
