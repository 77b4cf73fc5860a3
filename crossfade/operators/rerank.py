"""Greedy re-ranking for relevance, popularity, novelty and genre diversity."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from crossfade.functions.scaling import scalar


_OPEN = "array<struct<score:double,track_id:bigint,genre_id:bigint,gains:boolean>>"
_PICKED = "array<struct<track_id:bigint,score:double>>"


def _given(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _greedy(rows: Column, n: int, bonus: float) -> Column:
    """The picks, in order, from an array of open tracks: a fold whose state is what is open and what is picked."""

    def state(still_open: Column, picked: Column) -> Column:
        return F.struct(still_open.alias("open"), picked.alias("picked"))

    def row(r: Column, score: Column, gains: Column) -> Column:
        return F.struct(score.alias("score"), r["track_id"].alias("track_id"), r["genre_id"].alias("genre_id"), gains.alias("gains"))

    def without(now: Column, grown: Column, best: Column) -> Column:
        other = F.filter(grown, lambda r: r["track_id"] != best["track_id"])
        # a track without genre ends nobody's bonus and never loses its own
        alike = lambda r: F.coalesce(r["genre_id"] == best["genre_id"], F.lit(False))
        left = F.transform(other, lambda r: row(r, r["score"], r["gains"] & ~alike(r)))
        pick = F.struct(best["track_id"].alias("track_id"), best["score"].alias("score"))
        return state(left, F.concat(now["picked"], F.array(pick)))

    def first(grown: Column) -> Column:
        """The best score, the lowest id of equal ones."""
        key = F.transform(grown, lambda r: F.struct(r["score"].alias("s"), (-r["track_id"]).alias("i"), r.alias("r")))
        return F.array_max(key)["r"]

    def round_of(now: Column, _: Column) -> Column:
        gained = F.transform(
            now["open"], lambda r: row(r, F.when(r["gains"], r["score"] + F.lit(bonus)).otherwise(r["score"]), r["gains"])
        )
        picked = _given(gained, lambda grown: _given(first(grown), lambda best: without(now, grown, best)))
        return F.when(F.size(now["open"]) == 0, now).otherwise(picked)

    nothing = F.array().cast(_PICKED)
    end = F.aggregate(F.sequence(F.lit(1), F.lit(n)), state(rows.cast(_OPEN), nothing), round_of)
    return end["picked"]


def rerank_multi_objective(
    recs: DataFrame,
    popularity: DataFrame,
    history: DataFrame,
    catalog: DataFrame,
    n: int = 10,
    diversity_weight: float = 0.3,
    popularity_weight: float = 0.1,
    novelty_weight: float = 0.2,
) -> DataFrame:
    """Pick n of the (user_id, track_id, score) rows per user, one at a time.

    Base score: weighted relevance, popularity / max popularity, and full diversity and novelty.
    In each round every open track whose genre has not been picked gains the diversity weight, then
    the best track is taken. Heard tracks are skipped; a track without genre always gains.

    Tracks of one genre always gain together, so their order never changes, and unpicked genres are
    entered in the order of their best track. Hence only the n best tracks of the n best genres of
    a user can be picked (a track without genre acts as a genre of its own), and the greedy loop
    gets at most n * n rows per user whatever the length of the list.
    """
    top = scalar(popularity, F.max("popularity_score"))
    share = F.when(top > 0, F.coalesce("popularity_score", F.lit(0)) / top).otherwise(F.lit(0.0))
    relevance_weight = 1 - diversity_weight - popularity_weight - novelty_weight
    # one row per track from both sides, so the recommendations are shuffled by track only once
    tracks = popularity.select("track_id", "popularity_score").join(
        catalog.select("track_id", "genre_id"), "track_id", "full"
    )
    base = (
        recs.select("user_id", "track_id", "score")
        .join(history.select("user_id", "track_id"), ["user_id", "track_id"], "left_anti")
        .join(tracks, "track_id", "left")
        .select(
            "user_id",
            "track_id",
            "genre_id",
            (
                F.col("score") * relevance_weight
                + diversity_weight
                + share * popularity_weight
                + novelty_weight
            ).alias("base"),
            # each track without genre is its own branch
            F.when(F.col("genre_id").isNull(), F.col("track_id")).alias("_alone"),
        )
    )
    best_first = [F.desc("base"), F.col("track_id")]
    branch = W.partitionBy("user_id", "genre_id", "_alone").orderBy(*best_first)
    upto_here = branch.rowsBetween(W.unboundedPreceding, W.currentRow)
    shortlist = (
        base.withColumn("_place", F.row_number().over(branch))
        .withColumn("_head", F.first(F.struct("base", "track_id")).over(upto_here))
        .filter(F.col("_place") <= n)
    )
    heads = W.partitionBy("user_id").orderBy(F.desc("_head.base"), F.col("_head.track_id"))
    row = F.struct(F.col("base").alias("score"), "track_id", "genre_id", F.lit(True).alias("gains"))
    return (
        shortlist.withColumn("_branch", F.dense_rank().over(heads))
        .filter(F.col("_branch") <= n)
        .groupBy("user_id")
        .agg(F.collect_list(row).alias("_rows"))
        .select("user_id", F.posexplode(_greedy(F.col("_rows"), n, diversity_weight)).alias("_at", "_pick"))
        .select("user_id", "_pick.track_id", "_pick.score", (F.col("_at") + 1).alias("rank"))
    )
