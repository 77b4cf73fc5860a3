import pytest

from crossfade.operators import reports
from crossfade.sources import manifest, tables


@pytest.fixture
def events(spark):
    return spark.createDataFrame([(1, 10, 2), (2, 11, 1)], "user_id long, track_id int, listen_count int").selectExpr(
        "*", "date'2022-01-01' as last_listen", "'x' as extra"
    )


def test_load_casts_and_prunes(spark, events, folder):
    tables.write_table(events, folder, "events")
    loaded = tables.load_table(spark, folder, "events")
    assert dict(loaded.dtypes) == {
        "user_id": "bigint", "track_id": "bigint", "listen_count": "bigint", "last_listen": "date",
    }
    one = tables.load_table(spark, folder, "events", ["user_id"])
    assert "ReadSchema: struct<user_id:bigint>" in one._jdf.queryExecution().executedPlan().toString()


def test_missing_table_and_column(spark, events, folder):
    with pytest.raises(FileNotFoundError, match="'events'"):
        tables.load_table(spark, folder, "events")
    tables.write_table(events.drop("listen_count"), folder, "events")
    with pytest.raises(ValueError, match="listen_count"):
        tables.load_table(spark, folder, "events")
    with pytest.raises(FileNotFoundError):
        tables.step_report(spark, folder, ["events", "items"])
    assert tables.step_report(spark, folder, ["events"]).first().n_rows == 2


def test_publish_areas(spark, events, folder):
    path = tables.publish(events, folder, "data", "events")
    assert path.endswith("/recsys/data/events.parquet") and spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        tables.publish(events, folder, "elsewhere", "events")


def test_buckets_resume(spark, folder):
    keys = spark.range(100).withColumnRenamed("id", "user_id")
    calls = []

    def build(part):
        calls.append(part.count())
        if len(calls) == 2:
            raise RuntimeError("lost")
        return part.selectExpr("user_id", "user_id * 2 as twice")

    with pytest.raises(RuntimeError):
        tables.write_in_buckets(keys, "user_id", build, f"{folder}/out", buckets=6, per_run=2)
    done = calls[0]
    found = tables.write_in_buckets(keys, "user_id", build, f"{folder}/out", buckets=6, per_run=2)
    assert sorted((r.user_id, r.twice) for r in found.collect()) == [(i, 2 * i) for i in range(100)]
    assert len(calls) == 4 and sum(calls[2:]) == 100 - done
    tables.write_in_buckets(keys, "user_id", build, f"{folder}/out", buckets=6, per_run=2)
    assert len(calls) == 4


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (10, "b")], "n int, s string")
    row = reports.describe(df).first()
    assert (row.n, row["min"], row.p25, row.p50, row.p75, row["max"]) == (4, 1.0, 2.0, 3.0, 3.0, 10.0)
    assert reports.null_counts(df).first().asDict() == {"n": 0, "s": 1}
    assert {r.s: r.n for r in reports.value_counts(df, "s").collect()} == {"a": 2, "b": 1, None: 1}
    assert reports.shape(df).first().asDict() == {"n_rows": 4, "n_columns": 2}
    assert [(r.column_name, r.n_null) for r in reports.table_profile(df).collect()] == [("n", 0), ("s", 1)]
    assert reports.column_types(df).count() == 2
    for exact in (True, False):
        assert [tuple(r) for r in reports.table_profile(df, exact).collect()] == [("n", "int", 4, 0, 4), ("s", "string", 4, 1, 2)]
    found = {(r.column_name, r.value): r.n for r in reports.all_value_counts(df).collect()}
    assert found == {("n", "1"): 1, ("n", "2"): 1, ("n", "3"): 1, ("n", "10"): 1, ("s", "a"): 2, ("s", "b"): 1, ("s", None): 1}


def test_profiles_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.5, None), (None, 2.5, 7)], "a int, `b.c` double, d long")
    rows = {r.column_name: r for r in reports.describe(df).collect()}
    assert (rows["a"].n, rows["a"].n_null, rows["a"]["mean"], rows["a"].p50) == (0, 2, None, None)
    assert (rows["b.c"]["mean"], round(rows["b.c"]["std"], 6), rows["d"]["std"]) == (2.0, 0.707107, None)
    none = reports.describe(df.limit(0)).collect()
    assert [(r.column_name, r.n, r.n_null, r["max"]) for r in none] == [(c, 0, 0, None) for c in df.columns]
    for exact in (True, False):
        assert [tuple(r)[2:] for r in reports.table_profile(df.limit(0), exact).collect()] == [(0, 0, 0)] * 3
    assert reports.all_value_counts(df.limit(0)).collect() == []


def test_sketched_distinct_counts(spark):
    row = reports.table_profile(spark.range(50_000).selectExpr("id % 20000 as x"), exact=False).first()
    assert abs(row.n_distinct - 20_000) < 0.04 * 20_000


def test_describe_reads_its_input_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.range(100).selectExpr("id a", "id % 7 b", "id / 3 c").mapInPandas(seen, "a long, b long, c double")
    assert {r.column_name: r.p50 for r in reports.describe(df).collect()}["b"] == 3.0
    assert reads.value == 100


def test_partial_table_is_not_resumed(spark, folder):
    import os

    tables.write_table(spark.range(100), folder, "ids")
    assert tables.existing_table(spark, folder, "ids").count() == 100
    os.remove(f"{folder}/ids.parquet/_SUCCESS")
    assert tables.existing_table(spark, folder, "ids") is None
    assert tables.existing_table(spark, folder, "none") is None


def test_buckets_refuse_another_count(spark, folder):
    keys = spark.range(50).withColumnRenamed("id", "k")
    tables.write_in_buckets(keys, "k", lambda part: part, f"{folder}/t", buckets=6)
    assert tables.write_in_buckets(keys, "k", lambda part: part, f"{folder}/t", buckets=6).count() == 50
    with pytest.raises(ValueError, match="buckets"):
        tables.write_in_buckets(keys, "k", lambda part: part, f"{folder}/t", buckets=4)


def test_buckets_refuse_another_model(spark, folder):
    keys = spark.range(50).withColumnRenamed("id", "k")
    calls = []

    def build(part):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return part

    with pytest.raises(RuntimeError):
        tables.write_in_buckets(keys, "k", build, f"{folder}/t", 6, 2, {"model": "a"})
    with pytest.raises(ValueError, match="made_with"):
        tables.write_in_buckets(keys, "k", build, f"{folder}/t", 6, 2, {"model": "b"})
    assert tables.write_in_buckets(keys, "k", build, f"{folder}/t", 6, 2, {"model": "a"}).count() == 50


def test_a_run_is_published_at_once(spark, events, folder):
    def df(n):
        return spark.range(n)

    with pytest.raises(FileNotFoundError):
        tables.published_table(spark, folder, "data", "items")
    tables.publish_run(spark, folder, {("data", "items"): df(3), ("recommendations", "similar"): df(4)}, {"run": "one"})
    seen = tables.published_table(spark, folder, "data", "items")
    broken = spark.range(5).selectExpr("assert_true(id < 2) as x")
    with pytest.raises(Exception):
        tables.publish_run(spark, folder, {("data", "items"): df(30), ("recommendations", "similar"): broken})
    counts = [tables.published_table(spark, folder, a, t).count() for a, t in (("data", "items"), ("recommendations", "similar"))]
    assert counts == [3, 4]  # nothing of the broken run is seen
    tables.publish_run(spark, folder, {("data", "items"): df(7)}, {"run": "two"})
    assert tables.published_table(spark, folder, "data", "items").count() == 7
    assert tables.published_table(spark, folder, "recommendations", "similar").count() == 4
    assert seen.count() == 3  # who began with the run before still reads it
    assert manifest.latest(spark, f"{folder}/recsys")[1]["about"] == {"run": "two"}
    with pytest.raises(ValueError):
        tables.publish_run(spark, folder, {("elsewhere", "items"): df(1)})


def test_commits_do_not_overwrite_each_other(spark, folder):
    assert manifest.latest(spark, folder) == (0, {})
    assert manifest.commit(spark, folder, {"a": 1}, 0) == 1
    with pytest.raises(RuntimeError, match="another writer"):
        manifest.commit(spark, folder, {"a": 2}, 0)
    assert manifest.latest(spark, folder) == (1, {"a": 1})
    assert manifest.commit(spark, folder, {"a": "ü"}, 1) == 2
    assert manifest.latest(spark, folder) == (2, {"a": "ü"}) and manifest.versions(spark, folder) == [1, 2]
    assert manifest.fingerprint({"a": 1, "b": 2}) == manifest.fingerprint({"b": 2, "a": 1}) != manifest.fingerprint({"a": 1})


@pytest.mark.parametrize("n, files", [(1000, 10), (4000, 40)])
def test_lookup_opens_the_files_of_its_key_only(spark, folder, n, files):
    df = spark.range(n).selectExpr("if(id % 4 = 0, 7, id * 13 % 1009) as k", "id as v").repartition(6)
    tables.write_for_lookup(df, folder, "t", "k", ["v"], rows=100)
    ranges = spark.read.parquet(f"{folder}/t.ranges.parquet").collect()
    assert len(ranges) == files and max(r.rows for r in ranges) <= 300  # the hot key is cut too
    for k in (7, 13, 500):
        found = tables.lookup(spark, folder, "t", "k", k)
        expected = df.filter(f"k = {k}")
        assert sorted(r.v for r in found.collect()) == sorted(r.v for r in expected.collect())
        opened = len(found.inputFiles())
        assert opened <= (files // 4 + 3 if k == 7 else 2)
    assert tables.lookup(spark, folder, "t", "k", 10**9).count() == 0
    assert tables.write_for_lookup(df.limit(0), folder, "none", "k").count() == 0
    assert tables.lookup(spark, folder, "none", "k", 1).count() == 0
