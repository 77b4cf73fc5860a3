"""Named queries over the sample tables: (spark, sf_dir) -> DataFrame.

A step is computed anew each time from the written tables of the steps before it (``Stages``),
which are shared by all queries of a session, just as steps of a batch run hand over.
"""

import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfade.functions.scaling import confidence, divide_by_max, min_max_scale
from crossfade.functions.text import clean_name, normalize_title, standardize_text
from crossfade.operators import (
    als,
    audit,
    catalog,
    evaluate,
    events,
    matrix,
    ordering,
    popularity,
    products,
    ranking,
    reports,
    rerank,
    serving,
    similar,
)
from crossfade.plans.stages import Parameters, Stages
from crossfade.session import shared_dir
from crossfade.sources import demo_mapping as demo
from crossfade.sources import tables
from crossfade.streaming import history as stream_history_module
from crossfade.streaming.live_blend import BLEND_SCHEMA, stream_blend

Query = Callable[[SparkSession, str], DataFrame]

K = 10
METRICS_K = 5
RERANK_LIST = 50
SAMPLE_USERS = 500
FEED_FILE_ROWS = 500_000

_stages: dict[tuple[str, str], Stages] = {}
_queries: dict[str, Query] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/crossfade/{uuid.uuid4().hex}"


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stages:
        _stages[key] = Stages(
            spark,
            scratch(spark),
            demo.tracks(spark, sf_dir),
            demo.catalog_names(spark, sf_dir),
            demo.interactions(spark, sf_dir),
            Parameters(),
        )
    return _stages[key]


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable types: whole numbers as bigint, fractions as rounded doubles."""

    def column(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            col = col.cast("long")
        elif isinstance(field.dataType, T.FractionalType):
            col = F.round(col.cast("double"), digits)
        return col.alias(field.name)

    return df.select(*map(column, df.schema.fields))


def query(function: Callable) -> Callable:
    """Register ``name_query(stages, spark, sf_dir)`` or ``name(...)`` under ``name``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(stages(spark, sf_dir), spark, sf_dir))

    _queries[function.__name__.removesuffix("_query")] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_queries)


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- sources and sinks ---------------------------------------------------------------------


@query
def raw_bundle(st, spark, sf_dir):
    """Write the three raw tables, load them with their schemas, count them."""
    root = scratch(spark)
    raw = zip(tables.RAW_TABLES, (st.tracks, st.names, st.interactions))
    for name, df in raw:
        tables.write_table(df, root, name)
    tables.load_raw(spark, root)
    return tables.step_report(spark, root, tables.RAW_TABLES)


@query
def projected_read(st, spark, sf_dir):
    """Users in the events table; only the user column is read."""
    st.events
    return tables.load_table(spark, st.root, "events", ["user_id"]).distinct()


@query
def step_report(st, spark, sf_dir):
    st.events
    return tables.step_report(spark, st.root, tables.PREPROCESSED_TABLES)


@query
def publish_roundtrip(st, spark, sf_dir):
    path = tables.publish(st.top_popular, scratch(spark), "recommendations", "top_popular")
    return spark.read.parquet(path)


@query
def bucketed_write(st, spark, sf_dir):
    """Popular recommendations built and written in user buckets."""
    train, top = st.train_events, st.top_popular
    return tables.write_in_buckets(
        st.test_users,
        "user_id",
        lambda users: popularity.recommend_popular(
            users, train.join(users, "user_id", "left_semi"), top, K, scores=st.popularity
        ),
        scratch(spark),
        buckets=4,
        per_run=2,
    )


# --- text ----------------------------------------------------------------------------------


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def _standard_documents(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", standardize_text("text").alias("text"))


@query
def standardize_text_query(st, spark, sf_dir):
    return _standard_documents(spark, sf_dir)


@query
def clean_name_query(st, spark, sf_dir):
    return _standard_documents(spark, sf_dir).select("doc_id", clean_name("text").alias("text"))


@query
def normalize_title_query(st, spark, sf_dir):
    return _standard_documents(spark, sf_dir).select(
        "doc_id", normalize_title("text").alias("text")
    )


@query
def cleaned_catalog_names(st, spark, sf_dir):
    """All three text functions on every catalog name."""
    std = st.names.select("id", "type", standardize_text("name").alias("name_std"))
    return std.select(
        "*", clean_name("name_std").alias("clean"), normalize_title("name_std").alias("title")
    )


# --- catalog -------------------------------------------------------------------------------


def _entities(st) -> catalog.Entities:
    return catalog.resolve_entities(st.tracks, st.names)


@query
def explode_items(st, spark, sf_dir):
    return catalog.explode_tracks(st.tracks)


@query
def dedup_artists(st, spark, sf_dir):
    return catalog.dedup_entities(catalog.build_entity_catalog(st.names, "artist"), "artist")


@query
def dedup_genres(st, spark, sf_dir):
    return catalog.dedup_entities(catalog.build_entity_catalog(st.names, "genre"), "genre")


@query
def dedup_albums_scoped(st, spark, sf_dir):
    return _entities(st).dedup["album"]


@query
def dedup_items_scoped(st, spark, sf_dir):
    return _entities(st).dedup["track"].drop("title_normalized", "track_group_id")


@query
def id_map(st, spark, sf_dir):
    maps = _entities(st).maps
    return _stack(
        df.toDF("raw_id", "canonical_id").withColumn("entity", F.lit(entity))
        for entity, df in maps.items()
    )


@query
def version_groups(st, spark, sf_dir):
    return (
        _entities(st)
        .dedup["track"]
        .select("track_name_std", "artist_id_canonical", "title_normalized", "track_group_id")
    )


@query
def items(st, spark, sf_dir):
    return catalog.build_items(_entities(st))


@query
def item_catalog(st, spark, sf_dir):
    return catalog.build_item_catalog(st.items)


# --- events, split, encoders ---------------------------------------------------------------


@query
def quantile_threshold(st, spark, sf_dir):
    return events.quantile_threshold(st.interactions)


@query
def events_query(st, spark, sf_dir):
    return events.build_events(st.interactions, st.catalog)


@query
def events_remapped(st, spark, sf_dir):
    """Events with raw track ids replaced by canonical ones."""
    return events.build_events(
        st.interactions, st.catalog, track_map=_entities(st).maps["track"]
    )


@query
def user_encoder(st, spark, sf_dir):
    return events.encode_labels(st.events, "user_id", "user_idx")


@query
def item_encoder(st, spark, sf_dir):
    return events.encode_labels(st.events, "track_id", "item_idx")


@query
def date_threshold(st, spark, sf_dir):
    return events.date_threshold(st.events)


@query
def date_threshold_given(st, spark, sf_dir):
    """Training events up to a given day; text that is no date falls back to the quantile."""
    given = events.date_threshold(st.events, explicit="16.12.1998")
    fallback = events.date_threshold(st.events, explicit="1998/12/16")
    sides = {"given": given, "fallback": fallback}
    return _stack(
        events.chrono_split(st.events, day)[0]
        .agg(F.count("*").alias("train_rows"))
        .select(F.lit(name).alias("threshold"), "train_rows")
        for name, day in sides.items()
    )


@query
def train_events(st, spark, sf_dir):
    return events.chrono_split(st.events, st.threshold)[0]


@query
def test_events(st, spark, sf_dir):
    return events.chrono_split(st.events, st.threshold)[1]


@query
def split_stats(st, spark, sf_dir):
    return events.split_stats(st.events, st.threshold)


@query
def interaction_matrix(st, spark, sf_dir):
    return events.interaction_matrix(st.train_events, st.user_encoder, st.item_encoder)


@query
def interaction_matrix_test(st, spark, sf_dir):
    return events.interaction_matrix(st.test_events, st.user_encoder, st.item_encoder)


@query
def packed_matrix(st, spark, sf_dir):
    """The training matrix written as blocks of compressed rows and read back."""
    return matrix.unpack(tables.write_table(matrix.pack(st.train_matrix), scratch(spark), "train_matrix"))


@query
def packed_matrix_slice(st, spark, sf_dir):
    """Rows 100 to 199 of it, read from the blocks that hold them."""
    blocks = tables.write_table(matrix.pack(st.train_matrix), scratch(spark), "train_matrix")
    return matrix.unpack(blocks, low=100, high=200)


@query
def confidence_weights(st, spark, sf_dir):
    return st.train_events.select(
        "user_id", "track_id", confidence("listen_count", 2.0).alias("confidence")
    )


@query
def data_summary(st, spark, sf_dir):
    return events.data_summary(st.events, st.train_matrix, st.user_encoder, st.item_encoder)


# --- popularity ----------------------------------------------------------------------------


@query
def pop_listen_count(st, spark, sf_dir):
    return popularity.popularity(st.events, "listen_count")


@query
def pop_user_count(st, spark, sf_dir):
    return popularity.popularity(st.events, "user_count")


@query
def pop_avg_listens(st, spark, sf_dir):
    return popularity.popularity(st.events, "avg_listens")


@query
def top_popular(st, spark, sf_dir):
    return popularity.top_popular(st.popularity, 100, st.catalog)


@query
def recommend_popular(st, spark, sf_dir):
    return popularity.recommend_popular(
        st.test_users, st.train_events, st.top_popular, K, scores=st.popularity
    )


# --- ranking data --------------------------------------------------------------------------


def _personal(spark, sf_dir, k=K):
    return demo.personal_scores(spark, sf_dir, k)


def _lists(st, spark, sf_dir):
    return ranking.candidate_lists(_personal(spark, sf_dir), st.top_popular)


def _labelled_lists(st, spark, sf_dir):
    return ranking.label_lists(_lists(st, spark, sf_dir), st.test_events)


def _merged(st, spark, sf_dir):
    return ranking.explode_lists(_lists(st, spark, sf_dir))


@query
def track_features(st, spark, sf_dir):
    return ranking.track_features(st.catalog, st.train_events)


@query
def popular_candidates(st, spark, sf_dir):
    return ranking.popular_candidates(st.test_users, st.top_popular)


@query
def als_candidates(st, spark, sf_dir):
    return ranking.als_candidates(_personal(spark, sf_dir))


@query
def merge_candidates(st, spark, sf_dir):
    return _merged(st, spark, sf_dir)


@query
def candidate_features(st, spark, sf_dir):
    return ranking.add_track_features(
        ranking.als_candidates(_personal(spark, sf_dir)),
        ranking.track_features(st.catalog, st.train_events),
    )


@query
def labels(st, spark, sf_dir):
    return ranking.explode_lists(_labelled_lists(st, spark, sf_dir))


@query
def users_with_positive(st, spark, sf_dir):
    """All candidates of the users with a heard one."""
    return ranking.explode_lists(ranking.lists_with_positive(_labelled_lists(st, spark, sf_dir)))


@query
def sample_negatives(st, spark, sf_dir):
    return ranking.explode_lists(ranking.sample_lists(_labelled_lists(st, spark, sf_dir)))


@query
def sample_negatives_of_rows(st, spark, sf_dir):
    """The same sample from rows, for users of any length. Users without a positive give none, so their rows are not
    written."""
    rows = ranking.explode_lists(ranking.lists_with_positive(_labelled_lists(st, spark, sf_dir)))
    return ranking.sample_negatives(tables.materialize(rows))


@query
def sample_keys(st, spark, sf_dir):
    return ordering.sample_keys(st.events, "user_id", SAMPLE_USERS)


@query
def minmax_scale(st, spark, sf_dir):
    return min_max_scale(ranking.als_candidates(_personal(spark, sf_dir)), "als_score")


@query
def max_scale(st, spark, sf_dir):
    return divide_by_max(st.popularity, "popularity_score")


@query
def rank_by_score(st, spark, sf_dir):
    merged = _merged(st, spark, sf_dir)
    scored = merged.select(
        "user_id", "track_id", (F.col("als_score") + F.col("popularity_score")).alias("score")
    )
    return ranking.rank_by_score(scored)


@query
def top_k_per_user(st, spark, sf_dir):
    return ranking.top_of_lists(_lists(st, spark, sf_dir), "popularity_score", K)


@query
def rerank_multi_objective(st, spark, sf_dir):
    return rerank.rerank_multi_objective(
        _personal(spark, sf_dir, RERANK_LIST), st.popularity, st.train_events, st.catalog, K
    )


# --- learnt models (no SQL form) -----------------------------------------------------------


@query
def als_factors(st, spark, sf_dir):
    """Fit the factor model on the training matrix; item factors."""
    return als.fit_als(st.train_matrix).itemFactors


@query
def als_recs(st, spark, sf_dir):
    return als.recommend_als(
        st.als_model, st.user_encoder, st.item_encoder, st.train_events, K
    )


@query
def vector_recs(st, spark, sf_dir):
    """The top products of ``als_recs`` on given vectors: each vector asks as a user for the best others among those
    that no event of its number is about."""
    vectors = demo.item_vectors(spark, sf_dir).withColumnRenamed("features", "vector")
    n = F.lit(vectors.count())
    heard = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        (F.col("user_id") % n).alias("query_id"), (F.col("event_id") % n).alias("item_id")
    )
    return products.top_k_products(
        vectors.withColumnRenamed("track_id", "query_id"),
        vectors.withColumnRenamed("track_id", "item_id"),
        K,
        heard.distinct(),
    )


@query
def als_similar(st, spark, sf_dir):
    vectors = als.item_vectors(st.als_model, st.item_encoder).toDF("track_id", "features")
    return similar.similar_items(vectors, K)


@query
def ranker_training_data(st, spark, sf_dir):
    """Training rows of the ranker on the learnt candidates."""
    features = ranking.track_features(st.catalog, st.train_events)
    return ranking.training_rows(st.personal_als, st.top_popular, features, st.test_events)


@query
def ranker_scores(st, spark, sf_dir):
    return ranking.run_ranking(
        st.personal_als,
        st.top_popular,
        st.catalog,
        st.train_events,
        st.test_events,
    )[1]


@query
def recommendations(st, spark, sf_dir):
    """How many final rows each user has."""
    return st.recommendations.groupBy("user_id").agg(F.count("*").alias("n_rows"))


@query
def feature_importance(st, spark, sf_dir):
    return ranking.feature_importance(spark, st.ranker)


@query
def rank_with_model(st, spark, sf_dir):
    lists = ranking.als_candidates(st.als_recs), st.popular_recs
    return ranking.rank_with_model(st.ranker, *lists, st.catalog, st.train_events)


# --- what must hold of learnt results, whatever was learnt -----------------------------------


@query
def factor_indexes(st, spark, sf_dir):
    """Who has factors, and how many: the users and items of the training matrix."""
    sides = {"user": st.als_model.userFactors, "item": st.als_model.itemFactors}
    return _stack(
        df.select(F.lit(side).alias("side"), F.col("id").alias("idx"), F.size("features").alias("n_factors"))
        for side, df in sides.items()
    )


@query
def saved_factors(st, spark, sf_dir):
    """A factor model saved and loaded again: its recorded parameters, its factors and how many of them changed."""
    path, model = f"{scratch(spark)}/als", st.als_model
    given = st.record["models"]["als"]["parameters"]
    als.save_als(model, path, given)
    again = als.load_als(path, given)
    both = model.userFactors.join(again.userFactors.toDF("id", "loaded"), "id", "full")
    return both.agg(
        F.count("*").alias("n_users"), F.count_if(~F.col("features").eqNullSafe(F.col("loaded"))).alias("n_changed")
    ).select("*", *(F.lit(value).alias(name) for name, value in als.als_parameters(spark, path).items()))


@query
def als_recs_audit(st, spark, sf_dir):
    """Per user with factors: the list's size and ranks; heard tracks and scores that are not the factors' product."""
    owners = als.user_vectors(st.als_model, st.user_encoder)
    items = als.item_vectors(st.als_model, st.item_encoder)
    rows = audit.with_products(st.personal_als, "user_id", "track_id", owners, items)
    return audit.audit_lists(rows, "user_id", "track_id", "score", refused=st.train_events)


@query
def als_similar_audit(st, spark, sf_dir):
    """Per track with factors: the list's size and ranks; itself as its neighbour, and wrong cosines."""
    items = als.item_vectors(st.als_model, st.item_encoder)
    lists = similar.similar_items(items.toDF("track_id", "features"), K)
    rows = audit.with_products(lists, "track_id", "similar_track_id", items, items, cosine=True)
    itself = st.item_encoder.select("track_id", F.col("track_id").alias("similar_track_id"))
    return audit.audit_lists(rows, "track_id", "similar_track_id", "similarity_score", refused=itself)


@query
def training_rows(st, spark, sf_dir):
    """What the ranker learns from, on given personal scores: positives, drawn negatives and their features."""
    features = ranking.track_features(st.catalog, st.train_events)
    return ranking.training_rows(_personal(spark, sf_dir), st.top_popular, features, st.test_events, sample_users=None)


@query
def recommendations_audit(st, spark, sf_dir):
    """Per user: the final list's size and ranks; rows from outside the candidates, and targets that are not the
    test events'."""
    rows = st.recommendations
    heard = st.test_events.select("user_id", "track_id", F.lit(1).alias("_heard"))
    rows = rows.join(heard, ["user_id", "track_id"], "left")
    targets = rows.groupBy("user_id").agg(
        F.count_if(F.col("target") != F.coalesce("_heard", F.lit(0))).alias("n_wrong_targets"),
        F.count_if(~F.coalesce(F.col("score").between(0, 1), F.lit(False))).alias("n_no_probability"),
    )
    return audit.audit_lists(rows, "user_id", "track_id", "score", allowed=st.personal_als, shared=st.top_popular).join(targets, "user_id")


@query
def rank_with_model_audit(st, spark, sf_dir):
    """Per user found in both candidate lists: size and ranks, and rows from outside the two lists."""
    given = [df.select("user_id", "track_id") for df in (st.als_recs, st.popular_recs)]
    return audit.audit_lists(st.ranked_recs, "user_id", "track_id", "score", allowed=_stack(given))


@query
def importance_audit(st, spark, sf_dir):
    """The ranker's features, whether each share lies between 0 and 100, and the sum of all."""
    shares = ranking.feature_importance(spark, st.ranker)
    total = shares.agg(F.round(F.sum("importance"), 6).alias("total"))
    return shares.select("feature", F.col("importance").between(0, 100).alias("in_range"), total.scalar().alias("total"))


@query
def evaluation_users(st, spark, sf_dir):
    """For each model: the users it was judged on, and whether all five metrics are possible values."""
    share = ["precision_at_k", "recall_at_k", "ndcg_at_k", "diversity_at_k"]
    possible = reduce(lambda a, b: a & b, [F.col(name).between(0, 1) for name in share]) & (F.col("novelty_at_k") > -1e-6)
    return _stack(
        st.evaluation(model).select(
            F.lit(model).alias("model"), "total_users", "evaluated_users", F.coalesce(possible, F.lit(False)).alias("possible")
        )
        for model in ("popularity", "als", "ranked")
    )


# --- metrics -------------------------------------------------------------------------------


@query
def precision_at_k(st, spark, sf_dir):
    return evaluate.precision_at_k(st.popular_recs, st.test_events, METRICS_K, st.test_users)


@query
def recall_at_k(st, spark, sf_dir):
    return evaluate.recall_at_k(st.popular_recs, st.test_events, METRICS_K, st.test_users)


@query
def ndcg_at_k(st, spark, sf_dir):
    return evaluate.ndcg_at_k(st.popular_recs, st.test_events, METRICS_K, st.test_users)


@query
def novelty_at_k(st, spark, sf_dir):
    return evaluate.novelty_at_k(st.popular_recs, st.popularity, METRICS_K)


@query
def diversity_at_k(st, spark, sf_dir):
    return evaluate.diversity_at_k(st.popular_recs, st.catalog, METRICS_K)


@query
def all_metrics(st, spark, sf_dir):
    return evaluate.all_metrics(
        _personal(spark, sf_dir), st.test_events, st.popularity, st.catalog, K
    )


@query
def evaluate_popularity(st, spark, sf_dir):
    return st.evaluation("popularity")


@query
def compare_models(st, spark, sf_dir):
    """Two models through their JSON documents."""
    root = scratch(spark)
    lists = {"popularity": st.popular_recs, "als": _personal(spark, sf_dir)}
    for model, recs in lists.items():
        row = evaluate.evaluate(
            recs, st.test_events, st.events, st.popularity, st.catalog, K
        )
        document = tables.evaluation_document(row, model, K, "2025-01-01")
        tables.write_evaluation(document, root, model)
    return evaluate.compare_models(spark, root)


@query
def evaluate_als(st, spark, sf_dir):
    return st.evaluation("als")


@query
def evaluate_ranked(st, spark, sf_dir):
    return st.evaluation("ranked")


# --- serving -------------------------------------------------------------------------------


def _personal_lists(st, spark, sf_dir):
    """Every user with personal rows has a list."""
    return _personal(spark, sf_dir).select("user_id", "track_id", "rank")


def _offline(st, spark, sf_dir, k):
    feed = demo.online_events(spark, sf_dir).select("user_id")
    return serving.offline_recs(
        st.events.select("user_id").unionByName(feed),
        _personal_lists(st, spark, sf_dir),
        st.top_popular,
        k,
    )


def _similar(st, spark, sf_dir):
    vectors = demo.item_vectors(spark, sf_dir)
    return st.table("similar_vectors", lambda: similar.similar_items(vectors, K))


@query
def offline_recs(st, spark, sf_dir):
    return _offline(st, spark, sf_dir, K)


@query
def request_stats(st, spark, sf_dir):
    return serving.request_stats(_offline(st, spark, sf_dir, K))


@query
def similar_cosine(st, spark, sf_dir):
    return similar.similar_items(demo.item_vectors(spark, sf_dir), K)


@query
def similar_lookup(st, spark, sf_dir):
    """Similar tracks of the most popular track that has a vector."""
    vectors = _similar(st, spark, sf_dir).select("track_id").distinct()
    best = (
        st.popularity.join(vectors, "track_id", "left_semi")
        .orderBy(F.desc("popularity_score"), "track_id")
        .first()
    )
    return similar.similar_lookup(_similar(st, spark, sf_dir), best.track_id, K)


@query
def similar_lookup_sorted(st, spark, sf_dir):
    """The same from a table sorted by track, of which only the files that hold the track are opened."""
    root, table = scratch(spark), _similar(st, spark, sf_dir)
    tables.write_for_lookup(table, root, "similar", "track_id", ["rank"], rows=4096)
    best = (
        st.popularity.join(table.select("track_id").distinct(), "track_id", "left_semi")
        .orderBy(F.desc("popularity_score"), "track_id")
        .first()
    )
    return similar.similar_lookup(tables.lookup(spark, root, "similar", "track_id", best.track_id), best.track_id, K)


@query
def recent_events(st, spark, sf_dir):
    return serving.recent_events(demo.online_events(spark, sf_dir))


@query
def latest_events(st, spark, sf_dir):
    return serving.latest(serving.recent_events(demo.online_events(spark, sf_dir)))


@query
def online_recs(st, spark, sf_dir):
    recent = serving.recent_events(demo.online_events(spark, sf_dir))
    return serving.online_recs(recent, _similar(st, spark, sf_dir))


@query
def blend(st, spark, sf_dir):
    recent = serving.recent_events(demo.online_events(spark, sf_dir))
    online = serving.online_recs(recent, _similar(st, spark, sf_dir), 50)
    return serving.blend(online, _offline(st, spark, sf_dir, 50))


@query
def rec_lists(st, spark, sf_dir):
    """Lists to rows again: the popular recommendations through one list per user."""
    lists = serving.rec_lists(st.popular_recs, METRICS_K, "ids")
    return serving.flatten_lists(lists, F.col("ids"))


# --- streaming -----------------------------------------------------------------------------


def _streamed(spark, sf_dir, start) -> None:
    """Run ``start(events)`` over the feed in three micro-batches and a restart: two deals are there at first, one comes
    later. Deals are made by a hash of the event, so each holds events later and earlier than the others'. A deal is one
    file, or as many as its rows need, written and read side by side."""
    feed, vectors = scratch(spark), spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id",
        (F.col("event_id") % vectors).alias("track_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.pmod(F.hash("event_id"), F.lit(3)).alias("deal"),
    )
    files = max(1, -(-events.count() // (3 * FEED_FILE_ROWS)))
    for deals in ((0, 1), (2,)):
        for deal in deals:
            part = events.where(F.col("deal") == deal).drop("deal").repartition(files)
            part.write.mode("append").parquet(feed)
        stream = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", files).parquet(feed)
        start(stream).awaitTermination()


@query
def recent_events_stream(st, spark, sf_dir):
    root = scratch(spark)

    def start(events):
        updates = stream_history_module.stream_history(events)
        return stream_history_module.write_batches(updates, f"{root}/history", f"{root}/checkpoint", compact_every=2)

    _streamed(spark, sf_dir, start)
    return stream_history_module.latest_rows(
        spark, f"{root}/history", stream_history_module.HISTORY_SCHEMA
    )


@query
def blend_stream(st, spark, sf_dir):
    """Blended lists of all users with events, refreshed as events arrive."""
    root = scratch(spark)
    personal = tables.write_table(_personal_lists(st, spark, sf_dir), root, "personal")

    def start(events):
        return stream_blend(
            stream_history_module.stream_history(events),
            _similar(st, spark, sf_dir),
            personal,
            st.top_popular,
            f"{root}/blend",
            f"{root}/checkpoint",
        )

    _streamed(spark, sf_dir, start)
    return stream_history_module.latest_rows(spark, f"{root}/blend", BLEND_SCHEMA)


# --- reports -------------------------------------------------------------------------------


@query
def top_items(st, spark, sf_dir):
    return reports.top_items_report(st.events, st.catalog)


@query
def top_genres(st, spark, sf_dir):
    return reports.top_genres_report(st.events, st.items)


@query
def unheard_items(st, spark, sf_dir):
    """Catalogued tracks without any event."""
    return reports.unheard_items(st.items, st.events)


@query
def unheard_count(st, spark, sf_dir):
    """How many there are: a row also where none is unheard."""
    return reports.unheard_count(st.items, st.events)


@query
def null_counts(st, spark, sf_dir):
    return reports.null_counts(catalog.explode_tracks(st.tracks))


@query
def value_counts(st, spark, sf_dir):
    return reports.value_counts(st.interactions, "track_seq")


@query
def value_counts_all(st, spark, sf_dir):
    """Every value of every column of the interactions."""
    return reports.all_value_counts(st.interactions)


@query
def describe_events(st, spark, sf_dir):
    return reports.describe(st.events)


@query
def table_profile(st, spark, sf_dir):
    return reports.table_profile(st.items)
