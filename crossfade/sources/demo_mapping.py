"""The retail sample tables read as listening data: customers are users, parts are tracks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Part types in alphabetical order are genres 1..6.
GENRES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").withColumns(
        {
            "brand": F.substring("p_brand", 7, 9).cast("long"),
            "genre": F.array_position(F.array(*map(F.lit, GENRES)), F.col("p_type")).cast("long"),
            "size": F.col("p_size").cast("long"),
        }
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.col("brand")
    return _parts(spark, sf_dir).select(
        F.col("p_partkey").alias("track_id"),
        F.array("size").alias("albums"),
        F.when(F.col("p_size") % 5 == 0, F.array(brand, brand % 25 + 1))
        .when(F.col("p_size") % 3 == 0, F.array(brand + 100))
        .otherwise(F.array(brand))
        .alias("artists"),
        F.when(F.col("p_partkey") % 97 == 96, F.array().cast("array<bigint>"))
        .otherwise(F.array("genre"))
        .alias("genres"),
    )


def catalog_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    name, kind = F.col("p_name"), F.col("p_partkey") % 7
    track_name = (
        F.when(kind == 1, F.concat(name, F.lit(" (Live)")))
        .when(kind == 2, F.concat(name, F.lit(" - Remastered 2011")))
        .when(kind == 3, F.concat(name, F.lit(" feat. Someone")))
        .when(kind == 4, F.upper(name))
        .when(kind == 5, F.concat(name, F.lit(" cover")))
        .when(kind == 6, F.translate(name, "e", "é"))
        .otherwise(name)
    )

    def rows(df: DataFrame, entity: str, id_col, name_col) -> DataFrame:
        return df.select(id_col.alias("id"), F.lit(entity).alias("type"), name_col.alias("name"))

    brands = parts.select("brand").distinct()
    sizes = parts.select("size").distinct()
    genres = parts.select("genre", "p_type").distinct()
    brand, size = F.col("brand"), F.col("size")
    return (
        rows(parts, "track", F.col("p_partkey"), track_name)
        .unionByName(rows(brands, "artist", brand, F.concat(F.lit("Brand#"), brand)))
        .unionByName(rows(brands, "artist", brand + 100, F.concat(F.lit("BRAND "), brand)))
        .unionByName(rows(sizes, "album", size, F.concat(F.lit("Album "), size % 20)))
        .unionByName(rows(genres, "genre", F.col("genre"), F.col("p_type")))
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate"
    )
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("track_id"),
        F.col("l_quantity").cast("long").alias("track_seq"),
        F.col("l_shipdate").alias("started_at"),
    )


def personal_scores(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """A stand-in for learnt personal recommendations with exactly known scores.

    Per customer the k parts with the highest line price; lets every step after the factor model
    be checked against SQL.
    """
    from crossfade.operators.ordering import top_k_per_key

    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    scored = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("track_id"))
        .agg((F.max("l_extendedprice") / 99991).alias("score"))
    )
    return top_k_per_key(scored, ["user_id"], [F.desc("score"), F.col("track_id")], k)


def online_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, track_id, event_id, ts): the event feed, folded onto the tracks with a vector."""
    vectors = _read(spark, sf_dir, "embeddings").agg(F.count("*").alias("n"))
    return _read(spark, sf_dir, "events").select(
        "user_id",
        (F.col("event_id") % vectors.scalar()).alias("track_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("track_id"), F.col("embedding").alias("features")
    )
