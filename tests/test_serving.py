import random
import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crossfade.operators import serving as S
from crossfade.sources import manifest
from crossfade.sources.tables import write_table
from crossfade.streaming.history import HISTORY_SCHEMA, latest_rows, stream_history, write_batches
from crossfade.streaming.live_blend import BLEND_SCHEMA, stream_blend

USER = 7
POPULAR = [101, 102, 103, 104, 105]
PERSONAL = [201, 202, 203, 204, 205]
SIMILAR = [301, 302, 303, 304, 305]
EVENTS = [401, 402, 403]


@pytest.fixture(scope="module")
def data(spark):
    def ranked(ids):
        rows = [(USER, t, i) for i, t in enumerate(ids, 1)]
        return spark.createDataFrame(rows, "user_id long, track_id long, rank int")

    top = [(t, 100.0 - t) for t in POPULAR]
    similar = [(e, t, 1.0 - 0.1 * i) for e in EVENTS for i, t in enumerate(SIMILAR, 1)]
    history = [(USER, e, i) for i, e in enumerate(EVENTS)]
    return {
        "users": spark.createDataFrame([(USER,)], "user_id long"),
        "top": spark.createDataFrame(top, "track_id long, popularity_score double"),
        "personal": ranked(PERSONAL),
        "nobody": ranked([]),
        "similar": spark.createDataFrame(similar, "track_id long, similar_track_id long, similarity_score double"),
        "history": spark.createDataFrame(history, "user_id long, track_id long, position long"),
        "no_history": spark.createDataFrame([], "user_id long, track_id long, position long"),
    }


@pytest.mark.parametrize(
    "personal, history, k, expected",
    [
        ("nobody", "no_history", 5, POPULAR),
        ("nobody", "history", 5, [301, 101, 302, 102, 303]),
        ("personal", "no_history", 5, PERSONAL),
        ("personal", "history", 6, [301, 201, 302, 202, 303, 203]),
    ],
)
def test_final_recommendations(data, personal, history, k, expected):
    offline = S.offline_recs(data["users"], data[personal], data["top"], k)
    online = S.online_recs(data[history], data["similar"], k)
    found = S.blend(online, offline, k).orderBy("rank").collect()
    assert [r.track_id for r in found] == expected
    assert [r["rank"] for r in found] == list(range(1, len(expected) + 1))
    stats = {r.source: r.request_count for r in S.request_stats(offline).collect()}
    assert stats == {"personal" if personal == "personal" else "default": 1}


@pytest.mark.parametrize(
    "online, offline, expected",
    [([1, 2, 3], [2, 9], [1, 2, 9]), ([1], [], []), ([], [4, 5], [4, 5]), ([3, 4], [3, 4], [3, 4])],
)
def test_blend_edges(spark, online, offline, expected):
    def ranked(ids):
        rows = [(1, t, i) for i, t in enumerate(ids, 1)]
        return spark.createDataFrame(rows, "user_id long, track_id long, rank int")

    found = S.blend(ranked(online), ranked(offline), 10).orderBy("rank").collect()
    assert [r.track_id for r in found] == expected


def test_online_uses_the_last_events_and_best_score(spark, data):
    history = spark.createDataFrame([(1, 5, 0), (1, 6, 1), (1, 8, 3)], "user_id long, track_id long, position long")
    similar = spark.createDataFrame(
        [(5, 50, 0.2), (5, 51, 0.9), (6, 50, 0.8), (6, 52, 0.1), (8, 99, 1.0)],
        "track_id long, similar_track_id long, similarity_score double",
    )
    found = S.online_recs(history, similar, 2).orderBy("rank").collect()
    assert [(r.track_id, r.score) for r in found] == [(51, 0.9), (50, 0.8)]
    with pytest.raises(ValueError, match="similarity_score"):
        S.online_recs(history, similar.drop("similarity_score"))


EVENT_SCHEMA = "user_id long, track_id long, event_id long, ts timestamp"
START = datetime(2024, 1, 1)


def test_history_keeps_eleven(spark):
    rows = [(1, 10 + i, i, START + timedelta(minutes=i)) for i in range(12)]
    found = S.recent_events(spark.createDataFrame(rows, EVENT_SCHEMA)).orderBy("position").collect()
    assert [r.track_id for r in found] == list(range(21, 10, -1))
    assert [r.position for r in found] == list(range(11))


def _event_batches(n_batches, seed=0):
    """A third of all rows belong to user 0; times are shuffled, so events also come late."""
    random.seed(seed)
    ids = list(range(300))
    random.shuffle(ids)
    rows = [
        (0 if i % 3 == 0 else i % 17, random.randint(0, 40), i, START + timedelta(minutes=i // 2))
        for i in ids
    ]
    return [rows[b::n_batches] for b in range(n_batches)]


def _stream(spark, folder, batches):
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, EVENT_SCHEMA).repartition(2)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        assert i >= 0
    return (
        spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    )


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_equals_batch(spark, folder):
    batches = _event_batches(3)
    events = _stream(spark, folder, batches)
    write_batches(stream_history(events), f"{folder}/out", f"{folder}/cp").awaitTermination()
    found = latest_rows(spark, f"{folder}/out", HISTORY_SCHEMA)
    expected = S.recent_events(spark.createDataFrame(sum(batches, []), EVENT_SCHEMA))
    cols = ("user_id", "position", "track_id")
    assert rows(found, *cols) == rows(expected, *cols)
    assert spark.read.parquet(f"{folder}/out/rows").select("batch_id").distinct().count() == 3


def test_stream_restarts_with_its_state(spark, folder):
    batches = _event_batches(2, seed=4)
    for i in range(2):
        events = _stream(spark, folder, batches[i : i + 1])
        write_batches(stream_history(events), f"{folder}/out", f"{folder}/cp").awaitTermination()
    found = latest_rows(spark, f"{folder}/out", HISTORY_SCHEMA)
    expected = S.recent_events(spark.createDataFrame(sum(batches, []), EVENT_SCHEMA))
    cols = ("user_id", "position", "track_id")
    assert rows(found, *cols) == rows(expected, *cols)


def test_stream_blend_equals_batch(spark, folder):
    batches = _event_batches(3, seed=2)
    similar = write_table(
        spark.createDataFrame(
            [(t, 500 + (t * s) % 60, 1.0 / (1 + s + t % 5)) for t in range(41) for s in range(6)],
            "track_id long, similar_track_id long, similarity_score double",
        ).dropDuplicates(["track_id", "similar_track_id"]),
        folder, "similar",
    )
    personal = spark.createDataFrame([(0, 900 + i, i) for i in range(1, 9)], "user_id long, track_id long, rank int")
    top = spark.createDataFrame([(500 + i, 50.0 - i) for i in range(10)], "track_id long, popularity_score double")
    stream_blend(
        stream_history(_stream(spark, folder, batches)), similar, personal, top,
        f"{folder}/out", f"{folder}/cp", k=6,
    ).awaitTermination()
    found = latest_rows(spark, f"{folder}/out", BLEND_SCHEMA)
    history = S.recent_events(spark.createDataFrame(sum(batches, []), EVENT_SCHEMA))
    offline = S.offline_recs(history.select("user_id"), personal, top, 6)
    expected = S.blend(S.online_recs(history, similar, 6), offline, 6)
    cols = ("user_id", "rank", "track_id")
    assert rows(found, *cols) == rows(expected, *cols)


def test_an_empty_answer_replaces_the_one_before(spark, folder):
    batches = [[(1, 5, 0, START), (2, 5, 1, START)], [(1, 6, 2, START + timedelta(minutes=1))]]
    for batch in batches:
        events = _stream(spark, folder, [batch])
        heard = lambda rows: rows.groupBy("user_id").agg(F.max("track_id").alias("track_id")).where("track_id = 5")
        write_batches(stream_history(events), f"{folder}/out", f"{folder}/cp", heard).awaitTermination()
    assert rows(latest_rows(spark, f"{folder}/out", "user_id long, track_id long"), "user_id", "track_id") == [(2, 5)]


def test_snapshots_replace_micro_batches(spark, folder):
    batches = _event_batches(9, seed=6)
    counts = []
    for i, batch in enumerate(batches):  # a restart before every file
        events = _stream(spark, folder, [batch])
        write_batches(
            stream_history(events), f"{folder}/out", f"{folder}/cp", compact_every=2, buckets=3
        ).awaitTermination()
        found = latest_rows(spark, f"{folder}/out", HISTORY_SCHEMA)
        expected = S.recent_events(spark.createDataFrame(sum(batches[: i + 1], []), EVENT_SCHEMA))
        cols = ("user_id", "position", "track_id")
        assert rows(found, *cols) == rows(expected, *cols)
        counts.append(sum(len(manifest.folders(spark, f"{folder}/out/{kind}")) for kind in ("rows", "users", "snapshots", "_commits")))
    assert max(counts) <= 2 * 2 * 2 + 2 + 2
    number, record = manifest.latest(spark, f"{folder}/out")
    assert number == 4 and record["upto"] == 7
    assert len(list(Path(f"{folder}/out/{record['snapshot']}").glob("*.parquet"))) <= 3


def test_a_batch_run_again_after_its_snapshot_changes_nothing(spark, folder):
    batches = _event_batches(3, seed=8)
    for batch in batches:
        write_batches(stream_history(_stream(spark, folder, [batch])), f"{folder}/out", f"{folder}/cp", compact_every=2).awaitTermination()
    cols = ("user_id", "position", "track_id")
    before = rows(latest_rows(spark, f"{folder}/out", HISTORY_SCHEMA), *cols)
    shutil.copytree(f"{folder}/out/rows/batch_id=2", f"{folder}/out/rows/batch_id=1", dirs_exist_ok=True)
    shutil.copytree(f"{folder}/out/users/batch_id=2", f"{folder}/out/users/batch_id=1", dirs_exist_ok=True)
    assert rows(latest_rows(spark, f"{folder}/out", HISTORY_SCHEMA), *cols) == before


def test_idle_users_are_forgotten(spark, folder):
    def run(*events):
        stream = _stream(spark, folder, [[(u, t, t, START + timedelta(days=d)) for u, t, d in events]])
        updates = stream_history(stream, idle_days=10, late="1 hour")
        write_batches(updates, f"{folder}/out", f"{folder}/cp").awaitTermination()
        return rows(latest_rows(spark, f"{folder}/out", HISTORY_SCHEMA), "user_id", "position", "track_id")

    assert run((1, 10, 0), (2, 20, 0)) == [(1, 0, 10), (2, 0, 20)]
    assert run((1, 11, 6)) == [(1, 0, 11), (1, 1, 10), (2, 0, 20)]  # moves the timer of user 1
    run((3, 30, 12))  # the watermark passes day 10
    assert run((3, 31, 12)) == [(1, 0, 11), (1, 1, 10), (3, 0, 31), (3, 1, 30)]
    assert run((2, 21, 13))[2] == (2, 0, 21)  # begins anew


def test_state_is_kept_in_rocksdb(spark, folder):
    write_batches(stream_history(_stream(spark, folder, _event_batches(1))), f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert list(Path(f"{folder}/cp/state").rglob("*.zip")) or list(Path(f"{folder}/cp/state").rglob("*.changelog"))


def test_no_output_is_a_clear_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        latest_rows(spark, f"{folder}/nothing", HISTORY_SCHEMA)
