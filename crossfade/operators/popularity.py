"""Popularity scores and popularity-based recommendations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crossfade.functions.scaling import scalar
from crossfade.operators.ordering import top_k_per_key
from crossfade.sources.tables import materialize

METHODS = ("listen_count", "user_count", "avg_listens")


def popularity(events: DataFrame, method: str = "listen_count") -> DataFrame:
    """(track_id, popularity_score) by total listens, distinct users, or listens per user."""
    listens, users = F.sum("listen_count"), F.countDistinct("user_id")
    scores: dict[str, Column] = {
        "listen_count": listens,
        "user_count": users,
        "avg_listens": listens / users,
    }
    if method not in scores:
        raise ValueError(f"unknown method {method!r}, use one of {', '.join(METHODS)}")
    return events.groupBy("track_id").agg(scores[method].alias("popularity_score"))


def top_popular(scores: DataFrame, n: int = 100, catalog: DataFrame | None = None) -> DataFrame:
    """The n best tracks in order, with name, artist and group when a catalog is given."""
    top = first_n(scores, n)
    if catalog is None:
        return top
    # at most n rows reach either broadcast, so the catalog itself is never shuffled
    wanted = F.broadcast(top.select("track_id"))
    metadata = catalog.select("track_id", "track_clean", "artist_id", "track_group_id").join(
        wanted, "track_id", "left_semi"
    )
    # sorted again after the join: a later limit must not be pushed through it onto the top-n
    return (
        top.join(F.broadcast(metadata), "track_id", "left")
        .select("track_id", "popularity_score", "track_clean", "artist_id", "track_group_id")
        .orderBy(F.desc("popularity_score"), "track_id")
    )


def first_n(top: DataFrame, n: int) -> DataFrame:
    """Cut to the n best rows, whatever was passed: the bound of every broadcast of ``top``."""
    return top.orderBy(F.desc("popularity_score"), "track_id").limit(n)


def as_ranked_list(top: DataFrame) -> Column:
    """A ``first_n`` table as one sorted array of (track_id, popularity_score).

    The array is a scalar subquery, so users meet it as a constant and no join is planned.
    """
    entry = F.struct(
        (-F.col("popularity_score")).alias("key"),
        F.col("track_id"),
        F.col("popularity_score").cast("double").alias("popularity_score"),
    )
    return scalar(top.select("track_id", "popularity_score"), F.sort_array(F.collect_list(entry)))


def recommend_popular(
    users: DataFrame,
    history: DataFrame,
    top: DataFrame,
    k: int = 10,
    n: int = 100,
    scores: DataFrame | None = None,
) -> DataFrame:
    """The k tracks of the n most popular ones that come first among those a user has not heard.

    Who has heard so many of them that fewer than k are left gets the rest of k from all tracks of
    ``scores``, the popularity table that ``top`` was taken from, if it is given (runs a job then).

    Only history rows about the n top tracks matter. They are picked with an n-row broadcast and
    collapse to at most n ids per user (map-side combined), so one small shuffle on the user
    replaces the users x n pairs an anti-join would need.
    """
    top = first_n(top.select("track_id", "popularity_score"), n)
    heard = (
        history.select("user_id", "track_id")
        .join(F.broadcast(top.select("track_id")), "track_id", "left_semi")
        .groupBy("user_id")
        .agg(F.collect_set("track_id").alias("_heard"))
    )
    fresh = F.filter("_top", lambda row: ~F.array_contains("_heard", row["track_id"]))
    lists = (
        users.select("user_id")
        .distinct()
        .join(heard, "user_id", "left")
        .withColumn("_heard", F.coalesce("_heard", F.array().cast("array<bigint>")))
        .withColumn("_top", as_ranked_list(top))
        .select("user_id", F.slice(fresh, 1, k).alias("_recs"))
    )
    recs = lists if scores is None else lists.filter(F.size("_recs") == k)
    recs = recs.select("user_id", F.posexplode("_recs").alias("_pos", "_rec")).select(
        "user_id",
        F.col("_rec.track_id").alias("track_id"),
        F.col("_rec.popularity_score").alias("popularity_score"),
        (F.col("_pos") + 1).alias("rank"),
    )
    if scores is None:
        return recs
    # no top list at all leaves the array null
    short = materialize(lists.filter(F.coalesce(F.size("_recs"), F.lit(0)) < k).select("user_id"))
    return recs if short.isEmpty() else recs.unionByName(_from_all(short, history, scores, k))


def _places(scores: DataFrame) -> DataFrame:
    """(place, track_id, popularity_score), best first from 1: sorted ranges, numbered each on its own."""
    best_first = scores.select("track_id", "popularity_score").orderBy(F.desc("popularity_score"), "track_id")
    numbered = materialize(best_first.withColumn("_at", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_range", F.shiftright("_at", 33))
    # a row per range
    before = F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    ranges = numbered.groupBy("_range").agg(F.count("*").alias("_n"))
    ranges = ranges.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return numbered.join(F.broadcast(ranges), "_range").select(
        place.alias("place"), "track_id", F.col("popularity_score").cast("double").alias("popularity_score")
    )


def _from_all(users: DataFrame, history: DataFrame, scores: DataFrame, k: int) -> DataFrame:
    """The k most popular tracks that each of these users has not heard: k are left among the first k + heard."""
    heard = materialize(history.select("user_id", "track_id").join(users, "user_id", "left_semi").distinct())
    depth = users.join(heard.groupBy("user_id").agg(F.count("*").alias("_n")), "user_id", "left")
    places = F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("_n", F.lit(0)) + k))
    fresh = (
        depth.select("user_id", places.alias("place"))
        .join(_places(scores), "place")
        .join(heard, ["user_id", "track_id"], "left_anti")
    )
    return top_k_per_key(fresh, ["user_id"], [F.col("place")], k).select(
        "user_id", "track_id", "popularity_score", "rank"
    )
