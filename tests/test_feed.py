from glob import glob
from types import SimpleNamespace

from pyspark.sql import functions as F

from crossfade.plans import registry
from crossfade.streaming.history import _History


def test_large_deals_of_the_feed_are_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "FEED_FILE_ROWS", 10)
    monkeypatch.setattr(registry, "scratch", lambda spark: f"{tmp_path}/feed")
    spark.range(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    events = spark.range(90).select(F.col("id").alias("event_id"), (F.col("id") % 5).alias("user_id"), F.timestamp_seconds("id").alias("ts"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    files = []

    def start(stream):
        assert stream.isStreaming
        return SimpleNamespace(awaitTermination=lambda: files.append(len(glob(f"{tmp_path}/feed/*.parquet"))))

    registry._streamed(spark, str(tmp_path), start)
    assert files == [6, 9]  # three for each deal
    fed = spark.read.parquet(f"{tmp_path}/feed")
    assert fed.count() == 90 and fed.select("event_id").distinct().count() == 90


class _Kept:
    def __init__(self, value):
        self.value, self.calls = value, []

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value


def test_the_store_is_asked_once_for_a_user():
    history = _History(3, None)
    history.kept = _Kept(None)
    rows = [SimpleNamespace(track_id=t, event_id=e, micros=m) for t, e, m in ((1, 10, 5), (2, 11, 7), (3, 12, 7))]
    found = [(r.user_id, r.track_id, r.position) for r in history.handleInputRows((9,), iter(rows), None)]
    assert found == [(9, 3, 0), (9, 2, 1), (9, 1, 2)]
    late = [SimpleNamespace(track_id=4, event_id=13, micros=6), SimpleNamespace(track_id=5, event_id=14, micros=None)]
    found = [(r.track_id, r.position) for r in history.handleInputRows((9,), iter(late), None)]
    assert found == [(3, 0), (2, 1), (4, 2)]
    assert history.kept.calls == ["get", "update"] * 2
    assert history.kept.value == ([3, 2, 4], [12, 11, 13], [7, 7, 6])
