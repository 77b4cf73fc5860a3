"""Similar tracks by cosine of their vectors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.operators.products import top_k_products


def _unit(vectors: DataFrame) -> DataFrame:
    """Vectors scaled to length 1; a zero vector stays zero and has similarity 0 to all."""
    values = F.col("features").cast("array<double>")
    length = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
    return vectors.select(
        "track_id",
        values.alias("_values"),
        F.when(length > 0, length).otherwise(F.lit(1.0)).alias("_length"),
    ).select(
        "track_id", F.transform("_values", lambda x: x / F.col("_length")).alias("vector")
    )


def similar_items(
    vectors: DataFrame, k: int = 10, only: DataFrame | None = None
) -> DataFrame:
    """(track_id, similar_track_id, similarity_score, rank) for all tracks, or those in ``only``.

    ``vectors`` is (track_id, features), for instance the item factors of the ALS model. The track
    itself is left out by id, whatever its place in the ranking.
    """
    unit = _unit(vectors)
    wanted = unit
    if only is not None:
        wanted = unit.join(only.select("track_id").distinct(), "track_id", "left_semi")
    itself = wanted.select(F.col("track_id").alias("query_id"), F.col("track_id").alias("item_id"))
    return top_k_products(
        None if only is None else wanted.withColumnRenamed("track_id", "query_id"),
        unit.withColumnRenamed("track_id", "item_id"),
        k,
        itself,
    ).select(
        F.col("query_id").alias("track_id"),
        F.col("item_id").alias("similar_track_id"),
        F.col("score").alias("similarity_score"),
        "rank",
    )


def similar_lookup(similar: DataFrame, track_id: int, k: int = 10) -> DataFrame:
    """The k best similar tracks of one track; the filter reaches the parquet scan."""
    return (
        similar.filter(F.col("track_id") == track_id)
        .orderBy(F.desc("similarity_score"), "similar_track_id")
        .limit(k)
        .select("similar_track_id", "similarity_score")
    )
