"""Ranking metrics at k.

Recommendations are rows (user_id, track_id, rank); relevant tracks are rows (user_id, track_id).
Every function returns one row. ``users(user_id)`` names the users that were asked for: those
without any recommendation count as 0 in recall and NDCG and are skipped by precision.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfade.functions.scaling import rank_gain, scalar, self_information
from crossfade.sources.tables import read_evaluations

PAIR = ["user_id", "track_id"]


def _mean(expr: Column, name: str) -> Column:
    return F.coalesce(F.avg(expr), F.lit(0.0)).alias(name)


def user_scores(
    recs: DataFrame, relevant: DataFrame, k: int, users: DataFrame | None = None
) -> DataFrame:
    """Per asked user: recommended and relevant tracks, hits and their discounted gain.

    Recommendations and relevant tracks are stacked and grouped, first by pair, then by user: no
    join, and both groupings combine on the map side, so long histories do not pile up.
    """
    pairs = (
        recs.filter(F.col("rank") <= k)
        .select(*PAIR, F.col("rank").cast("int").alias("rank"), F.lit(0).alias("relevant"))
        .unionByName(
            relevant.select(*PAIR, F.lit(None).cast("int").alias("rank"), F.lit(1).alias("relevant"))
        )
        .groupBy(*PAIR)
        .agg(F.min("rank").alias("rank"), F.max("relevant").alias("relevant"))
        .select("*", F.lit(0).alias("asked"))
    )
    if users is not None:
        asked = users.select(
            "user_id",
            F.lit(None).cast("long").alias("track_id"),
            F.lit(None).cast("int").alias("rank"),
            F.lit(0).alias("relevant"),
            F.lit(1).alias("asked"),
        )
        pairs = pairs.unionByName(asked)
    hit = F.col("rank").isNotNull() & (F.col("relevant") == 1)
    scores = pairs.groupBy("user_id").agg(
        F.count("rank").alias("n_recs"),
        F.sum("relevant").alias("n_relevant"),
        F.count_if(hit).alias("hits"),
        F.sum(F.when(hit, rank_gain(F.col("rank"))).otherwise(0.0)).alias("gain"),
        F.max("asked").alias("asked"),
    )
    return scores.filter((F.col("n_recs") > 0) | (F.col("asked") == 1)).filter(
        F.col("n_relevant") > 0
    )


def _precision(k: int) -> Column:
    return _mean(F.when(F.col("n_recs") > 0, F.col("hits") / F.lit(k)), "precision_at_k")


def _recall() -> Column:
    return _mean(F.col("hits") / F.col("n_relevant"), "recall_at_k")


def _ndcg(k: int) -> Column:
    places = F.sequence(F.lit(1), F.least(F.col("n_relevant"), F.lit(k)).cast("int"))
    ideal = F.aggregate(places, F.lit(0.0), lambda total, rank: total + rank_gain(rank))
    return _mean(F.col("gain") / ideal, "ndcg_at_k")


def precision_at_k(recs, relevant, k: int, users: DataFrame | None = None) -> DataFrame:
    """Mean share of the k places that hold a relevant track."""
    return user_scores(recs, relevant, k, users).agg(_precision(k))


def recall_at_k(recs, relevant, k: int, users: DataFrame | None = None) -> DataFrame:
    """Mean share of the relevant tracks that were recommended."""
    return user_scores(recs, relevant, k, users).agg(_recall())


def ndcg_at_k(recs, relevant, k: int, users: DataFrame | None = None) -> DataFrame:
    """Mean discounted gain of the hits over the best possible one."""
    return user_scores(recs, relevant, k, users).agg(_ndcg(k))


def novelty_at_k(recs: DataFrame, popularity: DataFrame, k: int) -> DataFrame:
    """Mean self-information over all recommended rows; an unknown track has popularity 1.

    Rows are counted per track first, so a track recommended to everybody joins as one row.
    """
    top = scalar(popularity, F.max("popularity_score"))
    per_track = (
        recs.filter(F.col("rank") <= k).groupBy("track_id").agg(F.count("*").alias("n"))
    ).join(popularity.select("track_id", "popularity_score"), "track_id", "left")
    novelty = self_information(F.coalesce("popularity_score", F.lit(1)), top)
    return per_track.select("n", (novelty * F.col("n")).alias("novelty")).agg(
        F.coalesce(F.sum("novelty") / F.sum("n"), F.lit(0.0)).alias("novelty_at_k")
    )


def diversity_at_k(recs: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """Mean share of distinct version groups in a user's list; ``groups`` is the item catalog."""
    listed = (
        recs.filter(F.col("rank") <= k)
        .select(*PAIR)
        .join(groups.select("track_id", "track_group_id"), "track_id", "left")
        .select("user_id", F.coalesce("track_group_id", "track_id").alias("group_id"))
    )
    # a list has at most k groups, so the set is small and is combined on the map side
    per_user = listed.groupBy("user_id").agg(
        (F.size(F.collect_set("group_id")) / F.count("*")).alias("share")
    )
    return per_user.agg(_mean(F.col("share"), "diversity_at_k"))


def all_metrics(
    recs: DataFrame,
    relevant: DataFrame,
    popularity: DataFrame,
    groups: DataFrame,
    k: int = 10,
    users: DataFrame | None = None,
) -> DataFrame:
    """The five metrics as one row; the three hit-based ones share one pass."""
    accuracy = user_scores(recs, relevant, k, users).agg(_precision(k), _recall(), _ndcg(k))
    return accuracy.select(
        "*",
        scalar(novelty_at_k(recs, popularity, k), "novelty_at_k").alias("novelty_at_k"),
        scalar(diversity_at_k(recs, groups, k), "diversity_at_k").alias("diversity_at_k"),
    )


def evaluate(
    recs: DataFrame,
    test_events: DataFrame,
    events: DataFrame,
    popularity: DataFrame,
    groups: DataFrame,
    k: int = 10,
    users: DataFrame | None = None,
) -> DataFrame:
    """``all_metrics`` with the number of users in all events and of users evaluated."""
    asked = recs if users is None else users
    return all_metrics(recs, test_events, popularity, groups, k, users).select(
        "*",
        scalar(events.select("user_id").distinct(), F.count("*")).alias("total_users"),
        scalar(asked.select("user_id").distinct(), F.count("*")).alias("evaluated_users"),
    )


def compare_models(spark, root: str, models=("popularity", "als", "ranked")) -> DataFrame:
    """One row per model and k from the evaluation documents under ``root``."""
    return (
        read_evaluations(spark, root, models)
        .select(F.col("model_name").alias("model"), F.explode("metrics").alias("k", "values"))
        .select(
            "model",
            "k",
            *(
                F.col(f"values.`{name}@k`").alias(f"{name}_at_k")
                for name in ("precision", "recall", "ndcg", "novelty", "diversity")
            ),
        )
    )
