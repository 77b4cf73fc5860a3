"""Answers for users: precomputed lists, lists from the latest events, and the blend of both."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfade.functions import lists
from crossfade.operators.ordering import top_k_per_key
from crossfade.operators.popularity import as_ranked_list, first_n
from crossfade.sources.tables import require_columns


def offline_recs(users: DataFrame, personal: DataFrame, top: DataFrame, k: int = 10) -> DataFrame:
    """(user_id, track_id, rank, source): the first k personal tracks, else the k most popular.

    ``personal`` has a ``rank`` column. ``top`` is cut to k rows and meets the users as a constant.
    """
    require_columns(personal, ["user_id", "track_id", "rank"], "personal")
    asked = users.select("user_id").distinct()
    own = personal.join(asked, "user_id", "left_semi")
    own_recs = top_k_per_key(
        own.select("user_id", "track_id", F.col("rank").alias("_order")),
        ["user_id"],
        [F.col("_order"), F.col("track_id")],
        k,
    ).select("user_id", "track_id", "rank", F.lit("personal").alias("source"))
    default_recs = (
        asked.join(own.select("user_id"), "user_id", "left_anti")
        .withColumn("_top", as_ranked_list(first_n(top, k)))
        .select("user_id", F.posexplode("_top").alias("_pos", "_rec"))
        .select(
            "user_id",
            F.col("_rec.track_id").alias("track_id"),
            (F.col("_pos") + 1).alias("rank"),
            F.lit("default").alias("source"),
        )
    )
    return own_recs.unionByName(default_recs)


def request_stats(answers: DataFrame) -> DataFrame:
    """How many users were answered from each source; ``answers`` comes from ``offline_recs``."""
    return (
        answers.filter(F.col("rank") == 1)
        .groupBy("source")
        .agg(F.count("*").alias("request_count"))
    )


def recent_events(events: DataFrame, max_events: int = 10) -> DataFrame:
    """(user_id, track_id, position): the newest ``max_events`` + 1 events, newest at position 0."""
    newest = [F.desc("ts"), F.desc("event_id")]
    return top_k_per_key(events, ["user_id"], newest, max_events + 1, "_place").select(
        "user_id", "track_id", (F.col("_place") - 1).cast("long").alias("position")
    )


def latest(history: DataFrame, k: int = 5) -> DataFrame:
    return history.filter(F.col("position") < k)


def online_recs(
    history: DataFrame, similar: DataFrame, k: int = 5, num_events: int = 3
) -> DataFrame:
    """(user_id, track_id, score, rank): the best tracks similar to each user's last events.

    Each event contributes its k most similar tracks; a track found twice keeps its best score.
    Tracks already heard are not removed.
    """
    expected = ["track_id", "similar_track_id", "similarity_score"]
    require_columns(similar, expected, "similar")
    events = latest(history, num_events).select("user_id", "track_id").distinct()
    asked = similar.join(events.select("track_id").distinct(), "track_id", "left_semi")
    best = top_k_per_key(
        asked.select(*expected),
        ["track_id"],
        [F.desc("similarity_score"), F.col("similar_track_id")],
        k,
    )
    found = (
        events.join(best, "track_id")
        .groupBy("user_id", F.col("similar_track_id").alias("track_id"))
        .agg(F.max("similarity_score").alias("score"))
    )
    return top_k_per_key(found, ["user_id"], [F.desc("score"), F.col("track_id")], k)


def rec_lists(recs: DataFrame, k: int, name: str) -> DataFrame:
    """Rows to one ordered list of at most k ids per user."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "track_id")))
    return (
        recs.filter(F.col("rank") <= k)
        .groupBy("user_id")
        .agg(F.transform(ordered, lambda row: row["track_id"]).alias(name))
    )


def flatten_lists(rows: DataFrame, ids: Column) -> DataFrame:
    """Lists to (user_id, track_id, rank) rows."""
    return rows.select("user_id", F.posexplode(ids).alias("_pos", "track_id")).select(
        "user_id", "track_id", (F.col("_pos") + 1).alias("rank")
    )


def blend(online: DataFrame, offline: DataFrame, k: int = 50) -> DataFrame:
    """(user_id, track_id, rank): online and offline tracks in turn, online first.

    Stops at the end of the shorter list, drops repeats, keeps k. Users without online tracks get
    their offline list. Lists hold at most k ids.
    """
    both = rec_lists(online, k, "_online").join(
        rec_lists(offline, k, "_offline"), "user_id", "full"
    )
    empty = F.array().cast("array<bigint>")
    first, second = F.coalesce("_online", empty), F.coalesce("_offline", empty)
    mixed = lists.head(lists.keep_first(lists.interleave(first, second)), k)
    return flatten_lists(both, F.when(F.size(first) == 0, second).otherwise(mixed))
