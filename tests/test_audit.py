"""The audit of ranked lists: it finds each kind of fault, and none where there is none."""

from crossfade.operators.audit import audit_lists, with_products

LISTS = "user_id long, track_id long, score double, rank int"


def frame(spark, rows, schema=LISTS):
    return spark.createDataFrame(rows, schema)


def test_faults_are_counted_per_owner(spark):
    lists = frame(spark, [
        (1, 10, 3.0, 1), (1, 11, 2.0, 2), (1, 12, 2.0, 3),  # right; equal scores do not rise
        (2, 10, 1.0, 1), (2, 11, 4.0, 2), (2, 11, 3.0, 4),  # rises, repeats a track, leaves out a rank
    ])
    pairs = "user_id long, track_id long"
    allowed = frame(spark, [(1, 10), (1, 11), (1, 12), (1, 12), (2, 10)], pairs)
    refused = frame(spark, [(2, 10), (1, 99), (2, 10)], pairs)
    got = audit_lists(lists, "user_id", "track_id", "score", allowed, refused).orderBy("user_id").collect()
    assert [tuple(row) for row in got] == [(1, 3, 3, 1, 3, 0, 0, 0), (2, 3, 2, 1, 4, 1, 2, 1)]
    assert got[0].asDict().keys() == {
        "user_id", "n_rows", "n_items", "first_rank", "last_rank", "n_rising", "n_foreign", "n_refused"
    }


def test_shared_items_are_allowed_to_named_owners_and_nothing_is_broadcast(spark):
    lists = frame(spark, [(1, 10, 3.0, 1), (1, 50, 2.0, 2), (1, 11, 1.0, 3), (2, 50, 1.0, 1), (3, 10, 1.0, 1)])
    pairs = "user_id long, track_id long"
    allowed, shared = frame(spark, [(1, 10), (1, 10), (3, 99)], pairs), frame(spark, [(50,), (51,)], "track_id long")
    found = audit_lists(lists, "user_id", "track_id", "score", allowed, allowed, shared)
    assert {r["user_id"]: r["n_foreign"] for r in found.collect()} == {1: 1, 2: 1, 3: 1}
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_scores_are_held_against_the_vectors(spark):
    lists = frame(spark, [(1, 10, 11.0, 1), (1, 11, 4.0, 2), (2, 10, 0.9839, 1), (3, 10, 1.0, 1), (2, 12, None, 2)])
    owners = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])], "id long, v array<float>")
    items = frame(spark, [(10, [3.0, 4.0]), (11, [0.0, 1.0])], "id long, v array<double>")

    def wrong(cosine):
        rows = with_products(lists, "user_id", "track_id", owners, items, cosine)
        return {r["user_id"]: r["n_wrong"] for r in audit_lists(rows, "user_id", "track_id", "score").collect()}

    assert wrong(False) == {1: 1, 2: 2, 3: 1}  # 1 * 3 + 2 * 4 = 11; owner 3 and track 12 have no vector
    assert wrong(True) == {1: 2, 2: 1, 3: 1}


def test_no_lists(spark):
    assert audit_lists(frame(spark, []), "user_id", "track_id", "score").count() == 0
