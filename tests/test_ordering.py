import random

import pytest
from pyspark.sql import functions as F

from crossfade.operators.ordering import (
    dense_index,
    exact_quantiles,
    hash_order,
    histogram_quantiles,
    place_in_ranges,
    running_total,
    sample_keys,
    split_row_number,
    top_k_per_key,
    value_histogram,
)


def test_running_total_any_ranges(spark):
    random.seed(1)
    values = random.sample(range(-1000, 100_000), 500) + [2**62]
    rows = [(v, random.randint(0, 9)) for v in values]
    df = spark.createDataFrame(rows, "v long, w long")
    expected, total = {}, 0
    for v, w in sorted(rows):
        total += w
        expected[v] = total
    for rows in (2, 7, 256, 10_000):
        found = running_total(df, "v", "w", "t", rows).collect()
        assert {row.v: row.t for row in found} == expected


def test_dense_index(spark):
    ids = [5, 5, -3, 10**15, 7, 7, 7]
    found = dense_index(spark.createDataFrame([(i,) for i in ids], "id long"), "id", "idx")
    assert {r.id: r.idx for r in found.collect()} == {-3: 0, 5: 1, 7: 2, 10**15: 3}


def test_dense_index_of_many_ranges_and_several_columns(spark):
    rows = [(None if i % 9 == 0 else f"s{i % 37:02d}", i % 2 == 0) for i in range(500)]
    df = spark.createDataFrame(rows, "name string, flag boolean").repartition(5)
    expected = sorted(set(rows), key=lambda r: (r[1], r[0] is not None, r[0] or ""))
    for size in (3, 1000):
        found = dense_index(df, ["flag", "name"], "idx", size).collect()
        assert [(r.name, r.flag) for r in sorted(found, key=lambda r: r.idx)] == expected
        assert sorted(r.idx for r in found) == list(range(len(expected)))


def test_ranges_follow_the_number_of_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    for rows, parts in ((100, 10), (1000, 1)):
        placed = place_in_ranges(df, ["v"], rows)
        assert placed.select("_part").distinct().count() == parts
        largest = placed.groupBy("_part").count().agg(F.max("count")).first()[0]
        assert largest <= 2 * rows
    assert place_in_ranges(df.limit(0), ["v"]).count() == 0


def test_quantiles_of_several_columns_at_once(spark):
    random.seed(5)
    rows = [(random.randint(0, 30), random.random() if i % 4 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b double")
    histogram = value_histogram(df, {"a": F.col("a").cast("double"), "b": F.col("b")})
    histogram = histogram.filter("value is not null")
    levels = [0.0, 0.25, 0.5, 0.75, 1.0]
    expected = {}
    for k, name in enumerate("ab"):
        values = sorted(r[k] for r in rows if r[k] is not None)
        expected |= {(name, q): values[int((len(values) - 1) * q + 0.5)] for q in levels}
    for size in (9, 10_000):
        found = histogram_quantiles(histogram, levels, size).collect()
        assert {(r.column_name, r.q): r.value for r in found} == expected


@pytest.mark.parametrize("n", [1, 2, 11, 300])
def test_quantile_is_the_nearest_row(spark, n):
    random.seed(n)
    values = [random.choice([1, 1, 1, random.randint(0, 50)]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    levels = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    row = exact_quantiles(df, "v", levels).first()
    for name, q in levels.items():
        assert row[name] == sorted(values)[int((n - 1) * q + 0.5)]


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v long")
    assert exact_quantiles(df, "v", {"q": 0.5}).first().q is None


def test_split_row_number_equals_plain_rank(spark):
    random.seed(3)
    rows = [(0 if i % 3 else i % 50, random.randint(0, 99), i) for i in range(600)]
    df = spark.createDataFrame(rows, "key long, v long, id long")
    sliced = df.withColumn("part", F.floor(F.col("v") / 10))
    found = split_row_number(sliced, ["key"], "part", [F.col("v"), F.col("id")], "place").collect()
    expected = {}
    for key in {r[0] for r in rows}:
        mine = sorted((v, i) for k, v, i in rows if k == key)
        expected.update({i: place for place, (_, i) in enumerate(mine, 1)})
    assert {r.id: r.place for r in found} == expected


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), "id")
    top = top_k_per_key(df, ["key"], [F.desc("id")], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.key, r.id, r["rank"]) for r in top.collect())[:2] == [(0, 996, 2), (0, 999, 1)]


def test_sample_is_repeatable_and_distinct(spark):
    df = spark.range(100).select((F.col("id") % 40).alias("user_id"))
    first = [r.user_id for r in sample_keys(df, "user_id", 10).collect()]
    again = [r.user_id for r in sample_keys(df.repartition(7), "user_id", 10).collect()]
    assert sorted(first) == sorted(again) and len(set(first)) == 10
    other = [r.user_id for r in sample_keys(df, "user_id", 10, seed=1).collect()]
    assert sorted(other) != sorted(first)


def test_hash_order_depends_on_ids_only(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    import hashlib

    assert df.select(hash_order(42, "a", "b")).first()[0] == hashlib.md5(b"1:2:42").hexdigest()
