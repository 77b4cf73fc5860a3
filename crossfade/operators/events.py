"""Interactions -> per-user item counts, date split, id encoders and the interaction matrix."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfade.functions.scaling import scalar, sparsity_percent
from crossfade.operators.ordering import dense_index, exact_quantile


def quantile_threshold(interactions: DataFrame, quantile: float = 0.95) -> DataFrame:
    """One row: the largest ``track_seq`` still kept."""
    return exact_quantile(interactions, "track_seq", quantile, "threshold").select(
        F.col("threshold").cast("double").alias("threshold")
    )


def build_events(
    interactions: DataFrame,
    catalog: DataFrame,
    quantile: float = 0.95,
    track_map: DataFrame | None = None,
) -> DataFrame:
    """Listens and last day per (user, track) for catalogued tracks at or below the quantile.

    Raw track ids are used as they are, so listens of a track that is not canonical drop out;
    ``track_map`` (raw id -> canonical id) keeps them under the canonical id instead.

    Rows are counted per (user, track) before the semi-join: that shuffle is spread over both keys
    and pre-aggregated on the map side, so a track heard in a third of all rows lands in many
    tasks. Catalyst moves the semi-join below the count when the catalog is small enough to
    broadcast; otherwise it stays above, where AQE may split a hot track.
    """
    # in the type of the column, so that the comparison can be pushed to the parquet reader
    threshold = scalar(exact_quantile(interactions, "track_seq", quantile), "value")
    kept = interactions.filter(F.col("track_seq") <= threshold).select(
        "user_id", "track_id", F.to_date("started_at").alias("started_at")
    )
    counted = _count_listens(kept)
    if track_map is not None:
        counted = _merge_listens(
            counted.join(track_map, "track_id")
            .drop("track_id")
            .withColumnRenamed("track_id_canonical", "track_id")
        )
    return counted.join(catalog.select("track_id"), "track_id", "left_semi").select(
        "user_id", "track_id", "listen_count", "last_listen"
    )


def _count_listens(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "track_id").agg(
        F.count("*").alias("listen_count"), F.max("started_at").alias("last_listen")
    )


def _merge_listens(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "track_id").agg(
        F.sum("listen_count").alias("listen_count"), F.max("last_listen").alias("last_listen")
    )


def parse_date(text: str | None) -> date | None:
    """DD.MM.YYYY, or None when absent or malformed."""
    try:
        return datetime.strptime(text or "", "%d.%m.%Y").date()
    except ValueError:
        return None


def date_threshold(
    events: DataFrame, train_ratio: float = 0.8, explicit: str | None = None
) -> DataFrame:
    """One row with the last training day: the given date, else the quantile of ``last_listen``."""
    given = parse_date(explicit)
    if given is not None:
        return events.sparkSession.range(1).select(F.lit(given).alias("threshold"))
    days = exact_quantile(events, F.unix_date("last_listen"), train_ratio, "days")
    return days.select(F.date_from_unix_date(F.col("days").cast("int")).alias("threshold"))


def chrono_split(events: DataFrame, threshold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test): up to and including the threshold day, and after it."""
    day = scalar(threshold, "threshold")
    return events.filter(F.col("last_listen") <= day), events.filter(F.col("last_listen") > day)


def split_stats(events: DataFrame, threshold: DataFrame) -> DataFrame:
    """Rows, users and tracks per side.

    Users and tracks are first grouped per side, so both distinct counts run on pre-aggregated
    keys instead of an expansion of every event row.
    """
    side = F.when(F.col("last_listen") <= scalar(threshold, "threshold"), "train").otherwise("test")
    sided = events.select(side.alias("side"), "user_id", "track_id")
    users = (
        sided.groupBy("side", "user_id")
        .agg(F.count("*").alias("_n"))
        .groupBy("side")
        .agg(F.sum("_n").alias("interactions"), F.count("*").alias("users"))
    )
    tracks = sided.select("side", "track_id").distinct().groupBy("side").agg(
        F.count("*").alias("tracks")
    )
    return users.join(tracks, "side")


def encode_labels(events: DataFrame, id_col: str, idx_col: str) -> DataFrame:
    """(id, 0-based index) over all ids of the events, train and test."""
    return dense_index(events, id_col, idx_col).withColumn(idx_col, F.col(idx_col).cast("int"))


def interaction_matrix(events: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Coordinate form (user_idx, item_idx, weight) of the user x item matrix."""
    return (
        events.select("user_id", "track_id", "listen_count")
        .join(users, "user_id")
        .join(items, "track_id")
        .select("user_idx", "item_idx", F.col("listen_count").cast("float").alias("weight"))
    )


def data_summary(
    events: DataFrame, matrix: DataFrame, users: DataFrame, items: DataFrame
) -> DataFrame:
    """One row about the data set and its matrix."""

    def size(df: DataFrame) -> Column:
        return scalar(df, F.count("*"))

    cells = matrix.agg(
        F.count("*").alias("n_interactions"),
        F.min("weight").alias("min_listens"),
        F.max("weight").alias("max_listens"),
        F.avg("weight").alias("avg_listens"),
    )
    return cells.select(
        size(users).alias("n_users"),
        size(items).alias("n_tracks"),
        "n_interactions",
        "min_listens",
        "max_listens",
        "avg_listens",
        scalar(events, F.sum("listen_count")).alias("total_listens"),
    ).select(
        "*",
        sparsity_percent(F.col("n_interactions"), F.col("n_users"), F.col("n_tracks")).alias(
            "sparsity"
        ),
        F.col("n_users").alias("matrix_rows"),
        F.col("n_tracks").alias("matrix_columns"),
        F.lit("float32").alias("matrix_dtype"),
    )
