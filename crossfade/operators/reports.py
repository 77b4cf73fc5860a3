"""Reports on the prepared tables and profiles of any table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfade.operators.ordering import histogram_quantiles, value_histogram
from crossfade.sources.tables import materialize


def top_items_report(events: DataFrame, catalog: DataFrame, n: int = 10) -> DataFrame:
    """The n most heard tracks with their names."""
    best_first = [F.desc("total_listen_count"), F.col("track_id")]
    top = (
        events.groupBy("track_id")
        .agg(F.sum("listen_count").alias("total_listen_count"))
        .orderBy(*best_first)
        .limit(n)
    )
    names = catalog.select("track_id", "track_clean").join(
        F.broadcast(top.select("track_id")), "track_id", "left_semi"
    )
    return top.join(F.broadcast(names), "track_id", "left").orderBy(*best_first)


def top_genres_report(events: DataFrame, items: DataFrame, n: int = 5) -> DataFrame:
    """The n genres with the most listens; a track counts once for each of its genres."""
    genres = items.select("track_id", "genre_clean").distinct()
    return (
        events.groupBy("track_id")
        .agg(F.sum("listen_count").alias("listens"))
        .join(genres, "track_id", "left")
        .groupBy("genre_clean")
        .agg(F.sum("listens").alias("total_listen_count"))
        .orderBy(F.desc("total_listen_count"), "genre_clean")
        .limit(n)
    )


def unheard_items(items: DataFrame, events: DataFrame) -> DataFrame:
    """Catalogued tracks without any event, with the names of their lowest item row."""
    first = F.min(F.struct("artist_id", "album_id", "genre_id", "track_clean", "artist_clean",
                           "album_clean", "genre_clean")).alias("_first")
    names = ("track_clean", "artist_clean", "album_clean", "genre_clean")
    return (
        items.join(events.select("track_id").distinct(), "track_id", "left_anti")
        .groupBy("track_id")
        .agg(first)
        .select("track_id", *(f"_first.{name}" for name in names))
    )


def unheard_count(items: DataFrame, events: DataFrame) -> DataFrame:
    """One row: catalogued tracks, and how many of them have no event."""
    heard = events.select("track_id").distinct().withColumn("_heard", F.lit(True))
    return (
        items.select("track_id")
        .distinct()
        .join(heard, "track_id", "left")
        .agg(F.count("*").alias("n_tracks"), F.count_if(F.col("_heard").isNull()).alias("n_unheard"))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row: nulls per column."""
    return df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in df.columns))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def _as_text(df: DataFrame) -> dict[str, Column]:
    return {name: F.col(f"`{name}`").cast("string") for name in df.columns}


def all_value_counts(df: DataFrame) -> DataFrame:
    """(column_name, value, n): how often each value of each column occurs, as text, null included, in one pass.
    Equal values are counted before the shuffle, which deals rows by column and value."""
    return value_histogram(df, _as_text(df))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long")
    )


def column_types(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string")


def describe(df: DataFrame) -> DataFrame:
    """Per numeric column: non-null count, nulls, mean, std, min, exact quartiles, max.

    One pass over ``df`` makes the histogram of all numeric columns, which is written; everything
    else comes from its distinct values. Runs jobs.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not numeric:
        raise ValueError("no numeric column")
    columns = {name: F.col(f"`{name}`").cast("double") for name in numeric}
    histogram = materialize(value_histogram(df, columns))
    filled = histogram.filter(F.col("value").isNotNull())
    times = F.when(F.col("value").isNotNull(), F.col("n"))
    basics = histogram.groupBy("column_name").agg(
        F.sum(times).alias("_n"),
        F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("_null"),
        (F.sum(F.col("value") * F.col("n")) / F.sum(times)).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    levels = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles = histogram_quantiles(filled, list(levels.values())).groupBy("column_name").agg(
        *(F.min(F.when(F.col("q") == q, F.col("value"))).alias(name) for name, q in levels.items())
    )
    # one row for each column on the broadcast sides
    spread = (
        filled.join(F.broadcast(basics.select("column_name", "_n", "mean")), "column_name")
        .groupBy("column_name")
        .agg(F.sum(F.col("n") * (F.col("value") - F.col("mean")) ** 2).alias("_squares"), F.first("_n").alias("_m"))
        .select(
            "column_name",
            F.when(F.col("_m") > 1, F.sqrt(F.col("_squares") / (F.col("_m") - 1))).alias("std"),
        )
    )
    names = df.sparkSession.createDataFrame([(name,) for name in numeric], "column_name string")
    for part in (basics, spread, quartiles):
        names = names.join(F.broadcast(part), "column_name", "left")
    zero = F.lit(0).cast("long")
    return names.select(
        "column_name", F.coalesce("_n", zero).alias("n"), F.coalesce("_null", zero).alias("n_null"),
        "mean", "std", "min", "p25", "p50", "p75", "max",
    )


def table_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: type, rows, nulls and distinct values (without null).

    Distinct values are counted in the histogram of all columns, in one pass. ``exact=False`` instead keeps a
    HyperLogLog sketch per column and task, of a few kilobytes, so that no value is shuffled; counts of many
    values are then off by a percent or two.
    """
    types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    frame = df.sparkSession.createDataFrame(types, "column_name string, column_type string")
    is_null = F.col("value").isNull()
    if exact:
        counts = value_histogram(df, _as_text(df)).groupBy("column_name").agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(is_null, F.col("n")).otherwise(0)).alias("n_null"),
            F.count("value").alias("n_distinct"),
        )
    else:
        cells = [F.struct(F.lit(name).alias("column_name"), col.alias("value")) for name, col in _as_text(df).items()]
        counts = df.select(F.inline(F.array(*cells))).groupBy("column_name").agg(
            F.count("*").alias("n_rows"),
            F.count_if(is_null).alias("n_null"),
            F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg("value")), F.lit(0).cast("long")).alias("n_distinct"),
        )
    zero = F.lit(0).cast("long")
    return frame.join(F.broadcast(counts), "column_name", "left").select(
        "column_name", "column_type", *(F.coalesce(name, zero).alias(name) for name in ("n_rows", "n_null", "n_distinct"))
    )
