"""Every named query against its SQL on the smallest sample, and a whole batch run."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from crossfade.plans.stages import Parameters, Stages, run_batch
from crossfade.sources import demo_mapping as demo
from crossfade.sources import manifest, tables

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    same, note = compare(spark, duck, SF_DIR, name, entry.queries()[name], SQL[name])
    assert same, note


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["user_id", "track_id", "popularity_score", "rank"]


def test_same_answer_with_other_partitions(spark):
    names = ["item_encoder", "items", "sample_negatives", "similar_cosine", "blend", "rerank_multi_objective"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    answers = []
    try:
        for partitions in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            answers.append(
                [sorted(map(tuple, entry.queries()[n](spark, SF_DIR).collect())) for n in names]
            )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert answers[0] == answers[1]


def test_run_batch(spark, folder):
    raw = {
        "tracks": demo.tracks(spark, SF_DIR),
        "catalog_names": demo.catalog_names(spark, SF_DIR),
        "interactions": demo.interactions(spark, SF_DIR),
    }
    for name, df in raw.items():
        tables.write_table(df, f"{folder}/raw", name)
    report = run_batch(
        spark, f"{folder}/raw", f"{folder}/out",
        Parameters(factors=8, iterations=3, ranker_iterations=3, evaluation_k=5, rec_buckets=3),
        publish_to=f"{folder}/public",
    )
    shown = tables.published_table(spark, f"{folder}/public", "recommendations", "recommendations")
    about = manifest.latest(spark, f"{folder}/public/recsys")[1]["about"]
    assert about["parameters"]["factors"] == 8 and set(about["models"]) == {"als", "ranker"}
    rows = {r.table_name: r.n_rows for r in report.collect()}
    assert rows["models_comparison"] == 3
    assert rows["train_events"] + rows["test_events"] == rows["events"]
    assert rows["recommendations"] == shown.count() > 0
    for name in ("items", "events", "personal_als", "similar", "recommendations", "top_popular"):
        tables.load_table(spark, f"{folder}/out", name)
    personal = spark.read.parquet(f"{folder}/out/personal_als.parquet")
    train = spark.read.parquet(f"{folder}/out/train_events.parquet")
    assert personal.join(train, ["user_id", "track_id"]).count() == 0


def _stages(spark, folder, resume, **changed):
    return Stages(
        spark, folder, demo.tracks(spark, SF_DIR), demo.catalog_names(spark, SF_DIR),
        demo.interactions(spark, SF_DIR), Parameters(factors=5, iterations=2, rec_buckets=8, **changed), resume,
    )


def test_a_break_between_buckets_goes_on_with_the_same_model(spark, folder, monkeypatch):
    from crossfade.operators import als

    first, calls, real = _stages(spark, folder, False), [], als.recommend_als

    def breaks(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(als, "recommend_als", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        first.personal_als
    model = first.record["models"]["als"]
    assert model["parameters"]["regularization"] == 0.01 and "personal_als" not in first.record["tables"]
    with pytest.raises(ValueError, match="alpha"):
        _stages(spark, folder, True, alpha=2.0)
    monkeypatch.setattr(als, "fit_als", lambda *a, **k: pytest.fail("fitted again"))
    again = _stages(spark, folder, True)
    found = again.personal_als
    assert again.record["models"]["als"] == model and again.record["run"] == first.record["run"]
    assert len(calls) == 3  # two more of the four buckets each were left to one call
    whole = real(again.als_model, again.user_encoder, again.item_encoder, again.train_events, 10)
    cols = ["user_id", "rank", "track_id"]
    assert sorted(map(tuple, found.select(*cols).collect())) == sorted(map(tuple, whole.select(*cols).collect()))


def test_a_saved_model_knows_its_parameters(spark, folder):
    from crossfade.operators import als

    matrix = spark.range(60).selectExpr("cast(id % 7 as int) user_idx", "cast(id % 9 as int) item_idx", "1f weight")
    model = als.fit_als(matrix, factors=3, iterations=2, alpha=4.0)
    als.save_als(model, f"{folder}/m", {"alpha": 4.0})
    assert als.als_parameters(spark, f"{folder}/m") == {"alpha": 4.0}
    assert als.load_als(f"{folder}/m", {"alpha": 4.0}).rank == 3
    with pytest.raises(ValueError, match="alpha"):
        als.load_als(f"{folder}/m", {"alpha": 1.0})
    model.save(f"{folder}/cut_short")
    with pytest.raises(FileNotFoundError):
        als.load_als(f"{folder}/cut_short")


def test_stages_resume(spark, folder):
    def stages(resume):
        return Stages(
            spark, folder, demo.tracks(spark, SF_DIR), demo.catalog_names(spark, SF_DIR),
            demo.interactions(spark, SF_DIR), Parameters(), resume,
        )

    first = stages(False).catalog
    again = stages(True)
    again.table("tracks_catalog_clean", lambda: pytest.fail("written twice"))
    assert again.catalog.count() == first.count()


def test_users_with_positive_keeps_every_candidate(spark):
    labelled = [tuple(r) for r in entry.queries()["labels"](spark, SF_DIR).collect()]
    users = {r[0] for r in labelled if r[-1]}
    found = sorted(tuple(r) for r in entry.queries()["users_with_positive"](spark, SF_DIR).collect())
    assert found == sorted(r for r in labelled if r[0] in users) and len(found) > 100 * len(users) > 0
