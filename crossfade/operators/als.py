"""Implicit-feedback matrix factorisation and its recommendations."""

import uuid

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfade.functions.scaling import scalar
from crossfade.operators.normal_equations import iterate
from crossfade.operators.products import top_k_products
from crossfade.session import shared_dir
from crossfade.sources import manifest
from crossfade.sources.tables import materialize


def fit_als(
    matrix: DataFrame,
    factors: int = 64,
    regularization: float = 0.01,
    iterations: int = 15,
    alpha: float = 1.0,
    seed: int = 42,
    blocks: int | None = None,
) -> ALSModel:
    """Factorise (user_idx, item_idx, weight); confidence of a pair is 1 + alpha * weight.

    The model is MLlib's, with its first factors, its equations and the regularisation scaled with the number of ratings
    of each user and item; ``normal_equations`` solves them. ``blocks`` sets the user and item blocks (one task each per
    half-iteration). The default for the first factors, which depend on it, is the session's shuffle partition
    count; for the iterations see ``normal_equations.iterate``.
    """
    spark = matrix.sparkSession
    folder = f"{shared_dir(spark)}/crossfade/{uuid.uuid4().hex}"
    parts = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    als = ALS(
        rank=factors,
        maxIter=0,
        regParam=regularization,
        alpha=alpha,
        implicitPrefs=True,
        seed=seed,
        numUserBlocks=parts,
        numItemBlocks=parts,
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="weight",
    )
    matrix = materialize(matrix.select("user_idx", "item_idx", "weight"))
    model = als.fit(matrix)
    if not iterations:
        return model
    ratings = matrix.select(F.col("user_idx").cast("int"), F.col("item_idx").cast("int"), F.col("weight").cast("float"))
    found = iterate(ratings, model.userFactors, factors, iterations, alpha, regularization, blocks)
    model.write().save(folder)
    for name, side in zip(("userFactors", "itemFactors"), found):
        side.write.mode("overwrite").parquet(f"{folder}/{name}")
    return ALSModel.load(folder)


def save_als(model: ALSModel, path: str, parameters: dict | None = None) -> None:
    """The factors, then a record of what they were fitted with (the model itself only knows their number)."""
    model.write().overwrite().save(path)
    manifest.commit(model.userFactors.sparkSession, path, {"parameters": parameters or {}, "factors": model.rank}, 0)


def als_parameters(spark: SparkSession, path: str) -> dict:
    """What a saved model was fitted with. A model without its record was not saved to the end."""
    number, record = manifest.latest(spark, path)
    if not number:
        raise FileNotFoundError(f"no complete model at {path}")
    return record["parameters"]


def load_als(path: str, parameters: dict | None = None) -> ALSModel:
    """A saved model; with ``parameters`` one fitted with others is refused."""
    saved = als_parameters(SparkSession.getActiveSession(), path)
    if parameters is not None and parameters != saved:
        raise ValueError(f"the model at {path} was fitted with {saved}")
    return ALSModel.load(path)


def user_vectors(model: ALSModel, users: DataFrame) -> DataFrame:
    """(query_id = user_id, vector); users the model has not seen are left out."""
    factors = model.userFactors.select(F.col("id").alias("user_idx"), F.col("features"))
    return users.join(factors, "user_idx").select(
        F.col("user_id").alias("query_id"), F.col("features").alias("vector")
    )


def item_vectors(model: ALSModel, items: DataFrame) -> DataFrame:
    """(item_id = track_id, vector)."""
    factors = model.itemFactors.select(F.col("id").alias("item_idx"), F.col("features"))
    return items.join(factors, "item_idx").select(
        F.col("track_id").alias("item_id"), F.col("features").alias("vector")
    )


def _finite(vectors: DataFrame) -> DataFrame:
    return vectors.where(F.forall(F.col("vector").cast("array<double>"), lambda c: F.abs(c) < float("inf")))


def listed_users(model: ALSModel, users: DataFrame, items: DataFrame, history: DataFrame) -> DataFrame:
    """(user_id) of the users that ``recommend_als`` has a list for, found without any product: those with factors who
    have not heard every track with factors."""
    tracks = _finite(item_vectors(model, items)).select(F.col("item_id").alias("track_id"))
    heard = history.select("user_id", "track_id").distinct().join(tracks, "track_id", "left_semi")
    heard = heard.groupBy("user_id").agg(F.count("*").alias("_heard"))
    owners = _finite(user_vectors(model, users)).select(F.col("query_id").alias("user_id"))
    left = scalar(tracks, F.count("*")) - F.coalesce("_heard", F.lit(0))
    return owners.join(heard, "user_id", "left").where(left > 0).select("user_id")


def recommend_als(
    model: ALSModel,
    users: DataFrame,
    items: DataFrame,
    history: DataFrame | None = None,
    k: int = 10,
    only_users: DataFrame | None = None,
) -> DataFrame:
    """Top k tracks per user; pairs in ``history`` are never recommended.

    ``users`` and ``items`` are the encoders, ``only_users(user_id)`` narrows the users. Passing no
    ``history`` keeps tracks already heard.
    """
    if only_users is not None:
        users = users.join(only_users.select("user_id").distinct(), "user_id", "left_semi")
    excluded = None
    if history is not None:
        excluded = history.select(F.col("user_id").alias("query_id"), F.col("track_id").alias("item_id"))
        if only_users is not None:
            excluded = excluded.join(
                users.select(F.col("user_id").alias("query_id")), "query_id", "left_semi"
            )
    recs = top_k_products(user_vectors(model, users), item_vectors(model, items), k, excluded)
    return recs.select(
        F.col("query_id").alias("user_id"),
        F.col("item_id").alias("track_id"),
        F.col("score").cast("float").alias("score"),
        F.col("rank").cast("int").alias("rank"),
    )
