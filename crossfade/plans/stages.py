"""The batch run as a set of written tables, each built from the ones before it."""

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from crossfade.operators import als, catalog, evaluate, events, ordering, popularity, ranking, similar
from crossfade.sources import manifest, tables


@dataclass(frozen=True)
class Parameters:
    interaction_quantile: float = 0.95
    train_ratio: float = 0.8
    date_threshold: str | None = None
    popularity_method: str = "listen_count"
    top_n: int = 100
    n_recs: int = 10
    factors: int = 64
    regularization: float = 0.01
    iterations: int = 15
    alpha: float = 1.0
    similar_k: int = 10
    ranker_iterations: int = 100
    sample_users: int | None = 10_000
    negatives: int = 4
    evaluation_k: int = 10
    seed: int = 42
    # > 1: the two largest results are written in that many key buckets and resume by bucket
    rec_buckets: int = 1


# what a change of these parameters makes stale is only how the work was cut
_HOW = ("rec_buckets",)


@dataclass
class Stages:
    """Lazily written tables under ``root``; asking for one writes it and what it needs, once.

    Steps hand over through files: every table is computed once however many steps read it, and
    Spark plans each step with exact sizes.

    A commit record (``sources.manifest``) below ``root`` holds the parameters of the run, the tables that are
    complete and the models with their ids and parameters; it is written after what it names. With ``resume``
    the tables and models of the last record are kept, so buckets written before and after a break come from one
    model. Going on with other parameters is an error. Without ``resume`` a new record starts from nothing.
    """

    spark: SparkSession
    root: str
    tracks: DataFrame
    names: DataFrame
    interactions: DataFrame
    parameters: Parameters = field(default_factory=Parameters)
    resume: bool = False
    _done: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._number, last = manifest.latest(self.spark, self.root)
        given = {k: v for k, v in asdict(self.parameters).items() if k not in _HOW}
        if self.resume and last:
            changed = sorted(k for k in given.keys() | last["parameters"].keys() if given.get(k) != last["parameters"].get(k))
            if changed:
                raise ValueError(f"{self.root} was begun with other {', '.join(changed)}")
            self._record = last
        else:
            self._commit({"run": uuid.uuid4().hex, "parameters": given, "tables": [], "models": {}})

    def _commit(self, record: dict) -> None:
        self._number = manifest.commit(self.spark, self.root, record, self._number)
        self._record = record

    @property
    def record(self) -> dict:
        """The run's id, parameters, complete tables and models."""
        return self._record

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._done:
            found = None
            if name in self._record["tables"]:
                found = tables.existing_table(self.spark, self.root, name)
            if found is None:
                found = tables.write_table(build(), self.root, name)
                if name not in self._record["tables"]:
                    self._commit(self._record | {"tables": [*self._record["tables"], name]})
            self._done[name] = found
        return self._done[name]

    def _model(self, name: str, parameters: dict, fit: Callable[[], object], save, load):
        """A fitted model, kept below the run's own folder under a new id and noted when it is complete."""
        if name not in self._done:
            entry = self._record["models"].get(name)
            if entry is None:
                model, model_id = fit(), uuid.uuid4().hex
                entry = {"id": model_id, "path": f"models/{name}-{model_id}", "parameters": parameters}
                save(model, f"{self.root}/{entry['path']}")
                self._commit(self._record | {"models": self._record["models"] | {name: entry}})
            self._done[name] = load(f"{self.root}/{entry['path']}")
        return self._done[name]

    def _bucketed(self, name: str, keys: DataFrame, key: str, build, model: str) -> DataFrame:
        """``build(keys)``, as one write or in key buckets, all with the model of the last record."""
        if self.parameters.rec_buckets <= 1:
            return build(keys)
        getattr(self, f"{model}_model")  # complete and noted before the first bucket
        entry = self._record["models"][model]
        return tables.write_in_buckets(
            keys, key, build, f"{self.root}/buckets/{self._record['run']}/{name}", self.parameters.rec_buckets,
            made_with={"model": entry["id"], "parameters": manifest.fingerprint(self._record["parameters"])},
        )

    # preprocessing
    @property
    def items(self) -> DataFrame:
        return self.table(
            "items", lambda: catalog.build_items(catalog.resolve_entities(self.tracks, self.names))
        )

    @property
    def catalog(self) -> DataFrame:
        return self.table("tracks_catalog_clean", lambda: catalog.build_item_catalog(self.items))

    @property
    def events(self) -> DataFrame:
        return self.table(
            "events",
            lambda: events.build_events(
                self.interactions, self.catalog, self.parameters.interaction_quantile
            ),
        )

    @property
    def user_encoder(self) -> DataFrame:
        return self.table(
            "user_encoder", lambda: events.encode_labels(self.events, "user_id", "user_idx")
        )

    @property
    def item_encoder(self) -> DataFrame:
        return self.table(
            "item_encoder", lambda: events.encode_labels(self.events, "track_id", "item_idx")
        )

    # split
    @property
    def threshold(self) -> DataFrame:
        p = self.parameters
        return self.table(
            "date_threshold",
            lambda: events.date_threshold(self.events, p.train_ratio, p.date_threshold),
        )

    @property
    def train_events(self) -> DataFrame:
        return self.table(
            "train_events", lambda: events.chrono_split(self.events, self.threshold)[0]
        )

    @property
    def test_events(self) -> DataFrame:
        return self.table(
            "test_events", lambda: events.chrono_split(self.events, self.threshold)[1]
        )

    def _matrix(self, side: DataFrame) -> DataFrame:
        return events.interaction_matrix(side, self.user_encoder, self.item_encoder)

    @property
    def train_matrix(self) -> DataFrame:
        return self.table("train_matrix", lambda: self._matrix(self.train_events))

    @property
    def test_matrix(self) -> DataFrame:
        return self.table("test_matrix", lambda: self._matrix(self.test_events))

    # recommendations
    @property
    def popularity(self) -> DataFrame:
        return self.table(
            "popularity_track_scores",
            lambda: popularity.popularity(self.events, self.parameters.popularity_method),
        )

    @property
    def top_popular(self) -> DataFrame:
        return self.table(
            "top_popular",
            lambda: popularity.top_popular(self.popularity, self.parameters.top_n, self.catalog),
        )

    @property
    def als_model(self):
        p = self.parameters
        names = ("factors", "regularization", "iterations", "alpha", "seed")
        given = {name: getattr(p, name) for name in names}
        return self._model(
            "als",
            given,
            lambda: als.fit_als(self.train_matrix, **given),
            lambda model, path: als.save_als(model, path, given),
            lambda path: als.load_als(path, given),
        )

    def _personal(self, users: DataFrame | None) -> DataFrame:
        return als.recommend_als(
            self.als_model,
            self.user_encoder,
            self.item_encoder,
            self.train_events,
            self.parameters.n_recs,
            users,
        )

    @property
    def personal_als(self) -> DataFrame:
        users = self.user_encoder.select("user_id")
        return self.table(
            "personal_als", lambda: self._bucketed("personal_als", users, "user_id", self._personal, "als")
        )

    def _personal_of_sample(self) -> DataFrame:
        """The rows of ``personal_als`` that the ranker learns from. Unless all users' lists are there already, only the
        sampled users' are searched: the sample is drawn from those who will have a list."""
        p = self.parameters
        if p.sample_users is None or "personal_als" in self._record["tables"]:
            return self.personal_als
        listed = als.listed_users(self.als_model, self.user_encoder, self.item_encoder, self.train_events)
        return self._personal(tables.materialize(ordering.sample_keys(listed, "user_id", p.sample_users, p.seed)))

    @property
    def similar(self) -> DataFrame:
        def build(only: DataFrame) -> DataFrame:
            vectors = als.item_vectors(self.als_model, self.item_encoder)
            features = vectors.toDF("track_id", "features")
            return similar.similar_items(features, self.parameters.similar_k, only)

        keys = self.item_encoder.select("track_id")
        return self.table("similar", lambda: self._bucketed("similar", keys, "track_id", build, "als"))

    def _ranking_inputs(self) -> tuple[DataFrame, ...]:
        return self.personal_als, self.top_popular, self.catalog, self.train_events, self.test_events

    @property
    def ranker(self):
        p = self.parameters
        names = ("sample_users", "ranker_iterations", "negatives", "seed")
        given = {name: getattr(p, name) for name in names}

        def fit():
            inputs = self._personal_of_sample(), self.top_popular, self.catalog, self.train_events, self.test_events
            return ranking.train_ranker(*inputs, p.sample_users, p.ranker_iterations, p.negatives, p.seed)

        return self._model("ranker", given, fit, ranking.save_ranker, ranking.load_ranker)

    @property
    def recommendations(self) -> DataFrame:
        def build() -> DataFrame:
            inputs = self._ranking_inputs()  # all lists first, so that the ranker's are among them
            return ranking.rank_all(self.ranker, *inputs, self.parameters.n_recs)

        return self.table("recommendations", build)

    # evaluation: lists for the users of the test events
    @property
    def test_users(self) -> DataFrame:
        return self.test_events.select("user_id").distinct()

    @property
    def popular_recs(self) -> DataFrame:
        return self.table(
            "evaluated_popularity",
            lambda: popularity.recommend_popular(
                self.test_users,
                self.train_events,
                self.top_popular,
                self.parameters.n_recs,
                scores=self.popularity,
            ),
        )

    @property
    def als_recs(self) -> DataFrame:
        """The personal lists already exclude training tracks, so test users just look theirs up."""
        return self.personal_als.join(self.test_users, "user_id", "left_semi")

    @property
    def ranked_recs(self) -> DataFrame:
        def build() -> DataFrame:
            lists = ranking.als_candidates(self.als_recs), self.popular_recs
            return ranking.rank_with_model(
                self.ranker, *lists, self.catalog, self.train_events, self.parameters.n_recs
            )

        return self.table("evaluated_ranked", build)

    def evaluation(self, model: str) -> DataFrame:
        recs = {
            "popularity": lambda: self.popular_recs,
            "als": lambda: self.als_recs,
            "ranked": lambda: self.ranked_recs,
        }
        if model not in recs:
            raise ValueError(f"unknown model {model!r}")
        return evaluate.evaluate(
            recs[model](),
            self.test_events,
            self.events,
            self.popularity,
            self.catalog,
            self.parameters.evaluation_k,
            self.test_users,
        )

    def evaluate_all(self) -> DataFrame:
        """Write one metrics document per model and the comparison table."""
        k = self.parameters.evaluation_k
        for model in ("popularity", "als", "ranked"):
            document = tables.evaluation_document(
                self.evaluation(model), model, k, date.today().isoformat()
            )
            tables.write_evaluation(document, self.root, model)
        comparison = evaluate.compare_models(self.spark, self.root)
        return tables.write_table(comparison, self.root, "models_comparison")


def run_batch(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    parameters: Parameters | None = None,
    resume: bool = False,
    publish_to: str | None = None,
) -> DataFrame:
    """Raw tables to recommendations and their evaluation; returns a report of written tables.

    ``resume`` goes on from the tables and models of a run that was cut short. ``publish_to`` publishes the
    prepared data and the recommendations there when all is done, in one step (``tables.published_table``).
    """
    tracks, names, interactions = tables.load_raw(spark, raw_dir)
    stages = Stages(spark, out_dir, tracks, names, interactions, parameters or Parameters(), resume)
    stages.similar
    stages.recommendations
    stages.test_matrix
    stages.evaluate_all()
    if publish_to is not None:
        done = {("data", name): tables.existing_table(spark, out_dir, name) for name in tables.PREPROCESSED_TABLES}
        names = ("top_popular", "personal_als", "similar", "recommendations")
        done |= {("recommendations", name): tables.existing_table(spark, out_dir, name) for name in names}
        tables.publish_run(spark, publish_to, done, stages.record)
    return tables.step_report(
        spark,
        out_dir,
        [
            *tables.PREPROCESSED_TABLES,
            "train_events",
            "test_events",
            "train_matrix",
            "test_matrix",
            "popularity_track_scores",
            "top_popular",
            "personal_als",
            "similar",
            "recommendations",
            "models_comparison",
        ],
    )
