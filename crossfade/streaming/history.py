"""The per-user history of latest events, kept as streaming state, and the table of what a stream answers."""

import heapq
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from crossfade.sources import manifest

EVENT_COLUMNS = ["user_id", "track_id", "event_id", "ts"]
HISTORY_SCHEMA = "user_id long, track_id long, position long"
_EVENT_SCHEMA = "user_id long, track_id long, event_id long, micros long"
_STATE_SCHEMA = "track_ids array<long>, event_ids array<long>, micros array<long>"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_NO_NUMBER = -(1 << 63)  # what a missing number counts as: older than all

COMPACT_EVERY = 8  # micro-batches that are folded into a snapshot at a time
BUCKETS = 32  # files of a snapshot, by user


def _newest_per_user(limit: int):
    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.sort_values(["micros", "event_id"], ascending=False)
            yield rows.groupby("user_id", sort=False).head(limit)

    return combine


def _number(value: int | None) -> int:
    return _NO_NUMBER if value is None else value


class _History(StatefulProcessor):
    """Keeps the newest ``limit`` events of a user; forgets a user without events for ``idle`` milliseconds."""

    def __init__(self, limit: int, idle: int | None) -> None:
        self.limit, self.idle = limit, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", _STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.kept.get() or ([], [], [])  # one question to the store, not two
        tracks, ids, micros = old
        before = micros[0] if len(micros) else None
        given = ((_number(r.micros), _number(r.event_id), _number(r.track_id)) for r in rows)
        newest = heapq.nlargest(self.limit, chain(zip(micros, ids, tracks), given))
        micros, ids, tracks = (list(values) for values in zip(*newest))
        self.kept.update((tracks, ids, micros))
        if self.idle is not None and before != micros[0]:
            if before is not None:
                self.handle.deleteTimer(before // 1000 + self.idle)
            self.handle.registerTimer(micros[0] // 1000 + self.idle)
        for position, track in enumerate(tracks):
            yield Row(user_id=key[0], track_id=track, position=position)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.kept.clear()
        yield Row(user_id=key[0], track_id=None, position=None)

    def close(self) -> None:
        pass


def stream_history(
    events: DataFrame, max_events: int = 10, idle_days: float | None = None, late: str = "1 day"
) -> DataFrame:
    """Streaming form of ``operators.serving.recent_events``, in update mode.

    Emits the whole new history (``max_events`` + 1 rows at most) of every user with events in the
    micro-batch. Order is event time, then event id, so a late event takes its right place. Rows
    are first cut to the newest per user inside each Arrow batch, before the shuffle, so one very
    busy user does not flood the task that holds its state.

    State lies in RocksDB on the executors' disks with its changes in the checkpoint, so it does not have to fit in
    memory; the session is set to that store. ``idle_days`` bounds it in number: a timer of
    each user, moved on by every newer event, forgets users without events for so long, and emits a
    row without a track for them. Events more than ``late`` behind the newest are then dropped; without
    ``idle_days`` none is, and every user is kept.
    """
    spark = events.sparkSession
    spark.conf.set(_PROVIDER, _ROCKSDB)
    limit = max_events + 1
    slim = events.select("user_id", "track_id", "event_id", F.unix_micros("ts").alias("micros"))
    combined = slim.mapInPandas(_newest_per_user(limit), _EVENT_SCHEMA)
    idle = None
    if idle_days is not None:
        idle = int(idle_days * 86_400_000)
        combined = combined.withColumn("ts", F.timestamp_micros("micros")).withWatermark("ts", late)
    return combined.groupBy("user_id").transformWithState(
        _History(limit, idle), HISTORY_SCHEMA, "Update", "None" if idle is None else "EventTime"
    )


def write_batches(
    updates: DataFrame,
    path: str,
    checkpoint: str,
    transform=None,
    compact_every: int = COMPACT_EVERY,
    buckets: int = BUCKETS,
    **trigger,
) -> StreamingQuery:
    """Run an update stream into a table that ``latest_rows`` reads: a snapshot and the micro-batches after it.

    A micro-batch goes to its own folder; one that is run again after a failure overwrites it, so each is
    kept exactly once. ``transform`` maps the rows of a micro-batch before the write. ``trigger`` is
    passed on (``processingTime="1 minute"``); by default all input there is gets processed.

    Beside the rows, a folder lists the users of the micro-batch. It is written last, so a batch
    counts only with both, and a user whose answer is now empty loses the one before.

    After every ``compact_every`` micro-batches the last answer of each user goes to a new snapshot, in ``buckets``
    files by user, and one commit record puts it in the place of the old one and of these batches. What the
    record before named stays for readers that began with it and is removed at the next one, so the
    number of folders is bounded however long the stream runs.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        # the state is advanced once, however often the transformation reads the rows
        rows = rows.persist()
        try:
            some = rows.where("track_id is not null")  # users who were forgotten have no answer
            out = transform(some) if transform else some
            users = rows.select("user_id").distinct()
            out.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
            users.write.mode("overwrite").parquet(f"{path}/users/batch_id={batch_id}")
            schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields)
        finally:
            rows.unpersist()
        number, record = manifest.latest(updates.sparkSession, path)
        if batch_id - record.get("upto", -1) >= compact_every:
            compact(updates.sparkSession, path, schema, number, record, batch_id, buckets)

    return (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def compact(
    spark: SparkSession, path: str, schema: str, number: int, record: dict, upto: int, buckets: int
) -> None:
    """Fold the batches up to ``upto`` into a snapshot and remove what the record before this one left."""
    snapshot = f"snapshots/{number + 1:012d}"
    rows = _latest(spark, path, schema, record, upto)
    rows.repartition(buckets, "user_id").sortWithinPartitions("user_id").write.mode("overwrite").parquet(f"{path}/{snapshot}")
    manifest.commit(spark, path, {"snapshot": snapshot, "upto": upto, "before": record.get("upto", -1)}, number)
    for kind in ("rows", "users"):
        for name in manifest.folders(spark, f"{path}/{kind}"):
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= record.get("upto", -1):
                manifest.remove(spark, f"{path}/{kind}/{name}")
    for name in manifest.folders(spark, f"{path}/snapshots"):
        if f"snapshots/{name}" not in (snapshot, record.get("snapshot")):
            manifest.remove(spark, f"{path}/snapshots/{name}")
    for old in manifest.versions(spark, path)[:-2]:
        manifest.remove(spark, f"{path}/_commits/{old:012d}.json")


def _latest(spark: SparkSession, path: str, schema: str, record: dict, upto: int | None = None) -> DataFrame:
    def batches(kind: str, schema: str) -> DataFrame:
        df = spark.read.schema(f"{schema}, batch_id long").parquet(f"{path}/{kind}")
        df = df.where(F.col("batch_id") > record.get("upto", -1))
        return df if upto is None else df.where(F.col("batch_id") <= upto)

    last = batches("users", "user_id long").groupBy("user_id").agg(F.max("batch_id").alias("batch_id"))
    found = batches("rows", schema).join(last, ["user_id", "batch_id"]).drop("batch_id")
    if "snapshot" in record:
        older = spark.read.schema(schema).parquet(f"{path}/{record['snapshot']}")
        found = found.unionByName(older.join(last.select("user_id"), "user_id", "left_anti"))
    return found


def latest_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of each user from the last micro-batch that touched the user."""
    if not manifest.folders(spark, f"{path}/users"):
        raise FileNotFoundError(f"no micro-batch written under {path}")
    return _latest(spark, path, schema, manifest.latest(spark, path)[1])
