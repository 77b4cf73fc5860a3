"""Candidates, features, labels and the second-stage ranker."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from crossfade.functions.scaling import divide_by_max, min_max_scale, scalar
from crossfade.operators.ordering import hash_order, sample_keys, split_row_number
from crossfade.operators.popularity import as_ranked_list, first_n
from crossfade.session import shared_dir
from crossfade.sources.tables import materialize

PAIR = ["user_id", "track_id"]
_TOP = "array<struct<key:double,track_id:bigint,popularity_score:double>>"
TRACK_FEATURES = ["genre_popularity", "artist_popularity", "track_group_size"]
FEATURES = ["als_score", "popularity_score", *TRACK_FEATURES]

# rows of one user ranked in one task when sampling negatives
_SAMPLE_SLICE = 65_536


def track_features(catalog: DataFrame, events: DataFrame) -> DataFrame:
    """Listens of the track's genre and artist and the size of its version group, each / its max.

    Events are summed per track before they meet the catalog, so the joins see one row per track.
    Listens of tracks without genre or artist form a group of their own that counts for the max.
    """
    listens = (
        events.groupBy("track_id")
        .agg(F.sum("listen_count").alias("listens"))
        .join(catalog.select("track_id", "genre_id", "artist_id"), "track_id", "left")
    )

    def share(df: DataFrame, key: str, total, name: str) -> DataFrame:
        return divide_by_max(df.groupBy(key).agg(total.alias(name)), name)

    genre = share(listens, "genre_id", F.sum("listens"), "genre_popularity")
    artist = share(listens, "artist_id", F.sum("listens"), "artist_popularity")
    group = share(catalog, "track_group_id", F.count("track_id"), "track_group_size")
    return (
        catalog.select("track_id", "genre_id", "artist_id", "track_group_id")
        .join(genre, "genre_id", "left")
        .join(artist, "artist_id", "left")
        .join(group, "track_group_id", "left")
        .select("track_id", *(F.coalesce(name, F.lit(0.0)).alias(name) for name in TRACK_FEATURES))
    )


def popular_candidates(users: DataFrame, top: DataFrame, n: int = 100) -> DataFrame:
    """Every user with each of the n top tracks, score / best score."""
    best = first_n(top.select("track_id", "popularity_score"), n)
    scaled = divide_by_max(best, "popularity_score")
    return (
        users.select("user_id")
        .distinct()
        .withColumn("_top", as_ranked_list(scaled))
        .select("user_id", F.explode("_top").alias("_rec"))
        .select("user_id", "_rec.track_id", "_rec.popularity_score")
    )


def als_candidates(personal: DataFrame) -> DataFrame:
    return personal.select(*PAIR, F.col("score").cast("double").alias("als_score"))


def merge_candidates(
    als: DataFrame, popular: DataFrame, users: DataFrame | None = None
) -> DataFrame:
    """Both candidate sources on (user, track); a missing score is 0."""
    if users is not None:
        als = als.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return als.join(popular, PAIR, "full").select(
        *PAIR,
        F.coalesce("als_score", F.lit(0.0)).alias("als_score"),
        F.coalesce("popularity_score", F.lit(0.0)).alias("popularity_score"),
    )


def candidate_lists(personal: DataFrame, top: DataFrame, n: int = 100) -> DataFrame:
    """One row per user of ``personal``: ``candidates``, an array of (track_id, als_score, popularity_score) with the
    user's personal tracks and the n top tracks, each once; a missing score is 0.

    The same rows as ``merge_candidates`` of both sources, but the top tracks are a constant array: only the personal
    rows are shuffled, by user. Own tracks get their popularity before that, from the n top tracks, and a user with none
    among them takes the constant as it is. Personal lists hold at most k tracks.
    """
    scaled = divide_by_max(first_n(top.select("track_id", "popularity_score"), n), "popularity_score")
    scaled = materialize(scaled.select("track_id", F.col("popularity_score").cast("double").alias("popularity_score")))
    zero = F.lit(0.0)
    ranked = as_ranked_list(scaled)

    def entry(track: Column, als: Column, popularity: Column) -> Column:
        return F.struct(track.alias("track_id"), als.alias("als_score"), popularity.alias("popularity_score"))

    top_lists = scaled.sparkSession.range(1).withColumn("_top", F.coalesce(ranked, F.array().cast(_TOP)))
    constant = scalar(top_lists, F.transform("_top", lambda p: entry(p["track_id"], zero, p["popularity_score"])))
    popular = scaled.select("track_id", "popularity_score", F.lit(True).alias("_shared"))
    own = personal.select("user_id", "track_id", F.col("score").cast("double").alias("als_score"))
    own = own.join(F.broadcast(popular), "track_id", "left")
    # a null track, too, decides which others are kept
    shared = F.coalesce("_shared", F.col("track_id").isNull())
    mine = F.collect_list(entry(F.col("track_id"), F.col("als_score"), F.coalesce("popularity_score", zero)))
    others = F.filter("_top", lambda p: ~F.array_contains("_own.track_id", p["track_id"]))
    return (
        own.groupBy("user_id")
        .agg(mine.alias("_own"), F.bool_or(shared).alias("_meets"))
        .withColumn("_top", constant)
        .select("user_id", F.concat("_own", F.when(F.col("_meets"), others).otherwise(F.col("_top"))).alias("candidates"))
    )


def label_lists(lists: DataFrame, events: DataFrame) -> DataFrame:
    """Adds ``heard``: which of a user's candidates the user has events of. Events meet the list of their user, and
    only hits are collected, so it is no longer than the list however many events there are."""
    tracks = lists.select("user_id", F.col("candidates.track_id").alias("_tracks"))
    hits = (
        events.select(*PAIR)
        .join(tracks, "user_id")
        .filter(F.array_contains("_tracks", F.col("track_id")))
        .groupBy("user_id")
        .agg(F.collect_set("track_id").alias("heard"))
    )
    empty = F.array().cast("array<bigint>")
    return lists.join(hits, "user_id", "left").withColumn("heard", F.coalesce("heard", empty))


def lists_with_positive(lists: DataFrame) -> DataFrame:
    return lists.filter(F.size("heard") > 0)


def sample_lists(lists: DataFrame, multiplier: int = 4, seed: int = 42) -> DataFrame:
    """The lists of users with a positive, cut to all positives and at most ``multiplier`` negatives for each: the
    same choice as ``sample_negatives`` makes, without a shuffle."""
    is_heard = lambda c: F.array_contains("heard", c["track_id"])
    draw = lambda c: F.md5(F.concat_ws(":", F.col("user_id").cast("string"), c["track_id"].cast("string"), F.lit(str(seed))))
    negatives = F.filter("candidates", lambda c: ~is_heard(c))
    drawn = F.array_sort(
        F.transform(negatives, lambda c: F.struct(draw(c).alias("draw"), c["track_id"].alias("track_id"), c.alias("c")))
    )
    positives = F.filter("candidates", is_heard)
    some = F.slice(F.col("_drawn.c"), 1, F.size(positives) * multiplier)
    return (
        lists_with_positive(lists)
        .withColumn("_drawn", drawn)
        .withColumn("candidates", F.concat(positives, some))
        .drop("_drawn")
    )


def explode_lists(lists: DataFrame) -> DataFrame:
    """(user_id, track_id, als_score, popularity_score), and ``target`` if the lists are labelled."""
    columns = ["user_id", F.inline("candidates")]
    if "heard" not in lists.columns:
        return lists.select(*columns)
    rows = lists.select(*columns, "heard")
    return rows.withColumn("target", F.array_contains("heard", F.col("track_id")).cast("byte")).drop("heard")


def add_track_features(candidates: DataFrame, features: DataFrame) -> DataFrame:
    filled = {name: F.coalesce(name, F.lit(0.0)) for name in TRACK_FEATURES}
    return candidates.join(features, "track_id", "left").withColumns(filled)


def add_labels(candidates: DataFrame, events: DataFrame) -> DataFrame:
    """``target`` = 1 where the user heard the track in ``events``."""
    heard = events.select(*PAIR).distinct().withColumn("target", F.lit(1))
    return candidates.join(heard, PAIR, "left").withColumn(
        "target", F.coalesce("target", F.lit(0)).cast("byte")
    )


def users_with_positive(candidates: DataFrame) -> DataFrame:
    """All candidates of the users with at least one positive."""
    positive = candidates.filter(F.col("target") == 1).select("user_id").distinct()
    return candidates.join(positive, "user_id", "left_semi")


def sample_negatives(candidates: DataFrame, multiplier: int = 4, seed: int = 42) -> DataFrame:
    """All positives, and per user at most ``multiplier`` negatives for each of them.

    Negatives are taken in the order of a seeded hash of the pair. A user with very many negatives
    is cut into slices along that hash, each ranked in its own task. ``candidates`` is read four
    times, so pass a table or a materialized frame. Candidates that are lists: ``sample_lists``.
    """
    per_user = (
        candidates.groupBy("user_id")
        .agg(
            (F.count_if(F.col("target") == 1) * multiplier).alias("_wanted"),
            F.count_if(F.col("target") == 0).alias("_negatives"),
        )
        .filter(F.col("_wanted") > 0)
    )
    # the first 8 hex digits of the hash as a share of 2^32 pick the slice
    slices = F.ceil(F.col("_negatives") / _SAMPLE_SLICE)
    share = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    drawn = (
        candidates.filter(F.col("target") == 0)
        .join(per_user, "user_id")
        .withColumn("_hash", hash_order(seed, *PAIR))
        .withColumn("_slice", F.floor(share * slices))
    )
    sampled = split_row_number(
        drawn, ["user_id"], "_slice", [F.col("_hash"), F.col("track_id")], "_place"
    ).filter(F.col("_place") <= F.col("_wanted"))
    positives = candidates.filter(F.col("target") == 1)
    return positives.unionByName(sampled.select(*candidates.columns))


def fit_ranker(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    iterations: int = 100,
    learning_rate: float = 0.1,
    depth: int = 6,
    seed: int = 42,
) -> PipelineModel:
    """Boosted trees with log-loss on ``target``."""
    shared_dir(train.sparkSession)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    trees = GBTClassifier(
        featuresCol="features",
        labelCol="target",
        maxIter=iterations,
        stepSize=learning_rate,
        maxDepth=depth,
        lossType="logistic",
        seed=seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[assembler, trees]).fit(train)


def save_ranker(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_ranker(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance in percent), most important first."""
    shares = [float(x) * 100 for x in model.stages[-1].featureImportances.toArray()]
    schema = T.StructType(
        [T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]
    )
    rows = list(zip(model_features(model), shares))
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature")


def predict(model: PipelineModel, candidates: DataFrame) -> DataFrame:
    """Add ``score``, the probability of a positive; features the table lacks count as 0."""
    for name in model_features(model):
        if name not in candidates.columns:
            candidates = candidates.withColumn(name, F.lit(0.0))
    scored = model.transform(candidates)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def rank_by_score(scored: DataFrame, score: str = "score") -> DataFrame:
    """1-based ``rank`` per user, best score first. A user has at most one row per track."""
    order = W.partitionBy("user_id").orderBy(F.desc(score), "track_id")
    return scored.withColumn("rank", F.row_number().over(order))


def predict_and_rank(model: PipelineModel, candidates: DataFrame) -> DataFrame:
    return rank_by_score(predict(model, candidates))


def top_k_per_user(ranked: DataFrame, k: int = 10) -> DataFrame:
    return ranked.filter(F.col("rank") <= k)


def top_of_lists(lists: DataFrame, score: str, k: int = 10) -> DataFrame:
    """The rows ``top_k_per_user`` keeps of all ranked candidates, cut inside each list before rows are made: nothing is
    shuffled or sorted but one user's list."""
    entry = lambda c: F.struct(c[score].isNull(), -c[score], c["track_id"], c.alias("c"))
    best = F.slice(F.array_sort(F.transform("candidates", entry)), 1, k)
    return (
        lists.select("user_id", F.posexplode(best).alias("_pos", "_best"))
        .select("user_id", "_best.c.*", (F.col("_pos") + 1).alias("rank"))
    )


def scale_candidates(candidates: DataFrame, score: str) -> DataFrame:
    """Min-max scale one candidate score over the whole table."""
    return min_max_scale(candidates, score)


def labelled_lists(
    personal: DataFrame,
    top: DataFrame,
    label_events: DataFrame,
    sample_users: int | None = 10_000,
    seed: int = 42,
    only_positive_users: bool = True,
) -> DataFrame:
    """Candidate lists of the sampled users with what they heard of them."""
    if sample_users:
        users = sample_keys(personal, "user_id", sample_users, seed)
        personal = personal.join(users, "user_id", "left_semi")
    lists = label_lists(candidate_lists(personal, top), label_events)
    return lists_with_positive(lists) if only_positive_users else lists


def training_rows(
    personal: DataFrame,
    top: DataFrame,
    features: DataFrame,
    label_events: DataFrame,
    sample_users: int | None = 10_000,
    multiplier: int = 4,
    seed: int = 42,
) -> DataFrame:
    """What the ranker learns from: positives and sampled negatives; only these rows meet the track features."""
    lists = labelled_lists(personal, top, label_events, sample_users, seed)
    return add_track_features(explode_lists(sample_lists(lists, multiplier, seed)), features)


def train_ranker(
    personal: DataFrame,
    top: DataFrame,
    catalog: DataFrame,
    train_events: DataFrame,
    label_events: DataFrame,
    sample_users: int | None = 10_000,
    iterations: int = 100,
    multiplier: int = 4,
    seed: int = 42,
) -> PipelineModel:
    """The ranker, learnt from the candidates of at most ``sample_users`` users of ``personal``. Users without a
    positive give no rows, since negatives are drawn for positives.

    With the usual test events as labels the ranker sees the events it may later be judged on; pass
    other label events to keep them apart.
    """
    features = track_features(catalog, train_events)
    train = materialize(training_rows(personal, top, features, label_events, sample_users, multiplier, seed))
    return fit_ranker(train, iterations=iterations, seed=seed)


def rank_all(
    model: PipelineModel,
    personal: DataFrame,
    top: DataFrame,
    catalog: DataFrame,
    train_events: DataFrame,
    label_events: DataFrame,
    k: int = 10,
    n: int = 100,
) -> DataFrame:
    """The top k for every user of ``personal``; ``target`` is shown, not used.

    A top track that is not among a user's own has the same features, and so the same score, for every user: the n top
    tracks are scored once, and of them a user gets the k best beside the own ones. Only own rows meet the features and
    the model, and only the k best of a user meet the events.
    """
    features = materialize(track_features(catalog, train_events))
    best = first_n(top.select("track_id", "popularity_score"), n)
    best = materialize(divide_by_max(best, "popularity_score").select("track_id", F.col("popularity_score").cast("double")))
    columns = ["track_id", "als_score", "popularity_score", *TRACK_FEATURES, "score"]

    def scored(candidates: DataFrame) -> DataFrame:
        return predict(model, add_track_features(candidates, features))

    def by_score(c: Column) -> Column:
        return F.struct((-c["score"]).alias("key"), c["track_id"].alias("track_id"), c.alias("c"))

    popular = materialize(scored(best.withColumn("als_score", F.lit(0.0))).select(*columns))
    own = als_candidates(personal).join(F.broadcast(best), "track_id", "left")
    own = scored(own.withColumn("popularity_score", F.coalesce("popularity_score", F.lit(0.0))))
    entry = F.struct(*columns)
    others = F.filter("_top", lambda p: ~F.array_contains("_own.track_id", p["track_id"]))
    chosen = F.slice(F.array_sort(F.concat(F.transform("_own", by_score), F.slice(others, 1, k))), 1, k)
    lists = (
        own.groupBy("user_id")
        .agg(F.collect_list(entry).alias("_own"))
        .withColumn("_top", scalar(popular, F.sort_array(F.collect_list(by_score(entry)))))
        .select("user_id", F.transform(chosen, lambda x, i: x["c"].withField("rank", i + 1)).alias("candidates"))
    )
    rows = explode_lists(label_lists(lists, label_events))
    return rows.select("track_id", "user_id", *columns[1:3], "target", *columns[3:], "rank")


def run_ranking(
    personal: DataFrame,
    top: DataFrame,
    catalog: DataFrame,
    train_events: DataFrame,
    label_events: DataFrame,
    k: int = 10,
    sample_users: int | None = 10_000,
    iterations: int = 100,
    multiplier: int = 4,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Train the ranker and return it with the top k for every user of ``personal``: ``sample_users`` does
    not decide who gets a list."""
    inputs = (personal, top, catalog, train_events, label_events)
    model = train_ranker(*inputs, sample_users, iterations, multiplier, seed)
    return model, rank_all(model, *inputs, k)


def rank_with_model(
    model: PipelineModel,
    als: DataFrame,
    popular: DataFrame,
    catalog: DataFrame,
    train_events: DataFrame,
    k: int = 10,
    users: DataFrame | None = None,
    scaling: bool = True,
) -> DataFrame:
    """Apply a trained ranker to given candidate lists of the users found in both of them.

    ``scaling`` min-max scales both scores first. The two lists (a few rows per user) are read
    several times and therefore written to the shared folder.
    """
    both = als.select("user_id").intersect(popular.select("user_id"))
    if users is not None:
        both = both.join(users.select("user_id"), "user_id", "left_semi")
    als = materialize(als.select(*PAIR, "als_score").join(both, "user_id", "left_semi"))
    popular = materialize(popular.select(*PAIR, "popularity_score").join(both, "user_id", "left_semi"))
    if scaling:
        als = scale_candidates(als, "als_score")
        popular = scale_candidates(popular, "popularity_score")
    candidates = add_track_features(
        merge_candidates(als, popular), track_features(catalog, train_events)
    )
    return top_k_per_user(predict_and_rank(model, candidates), k)
