import math

import pytest

from crossfade.operators import evaluate as E
from crossfade.sources import tables


def recs(spark, lists):
    rows = [(u, t, i) for u, ids in lists.items() for i, t in enumerate(ids, 1)]
    return spark.createDataFrame(rows, "user_id long, track_id long, rank int")


def pairs(spark, lists):
    rows = [(u, t) for u, ids in lists.items() for t in ids]
    return spark.createDataFrame(rows, "user_id long, track_id long")


def test_hand_computed_user(spark):
    found, relevant = recs(spark, {1: [1, 2, 3]}), pairs(spark, {1: [1, 9, 9]})
    assert E.precision_at_k(found, relevant, 5).first()[0] == pytest.approx(0.2)
    assert E.recall_at_k(found, relevant, 5).first()[0] == pytest.approx(0.5)
    assert E.ndcg_at_k(found, relevant, 5).first()[0] == pytest.approx(1 / (1 + 1 / math.log2(3)))


def test_k_cuts_the_list(spark):
    found, relevant = recs(spark, {1: [5, 6, 1]}), pairs(spark, {1: [1]})
    assert E.recall_at_k(found, relevant, 2).first()[0] == 0.0
    assert E.ndcg_at_k(found, relevant, 3).first()[0] == pytest.approx(0.5)


def test_empty_lists_count_for_recall_but_not_precision(spark):
    found, relevant = recs(spark, {1: [1]}), pairs(spark, {1: [1], 2: [4], 3: [5]})
    users = pairs(spark, {1: [0], 2: [0]}).select("user_id")
    assert E.precision_at_k(found, relevant, 1, users).first()[0] == 1.0
    assert E.recall_at_k(found, relevant, 1, users).first()[0] == 0.5
    assert E.ndcg_at_k(found, relevant, 1, users).first()[0] == 0.5


def test_users_without_relevant_tracks_are_skipped(spark):
    found, relevant = recs(spark, {1: [1], 2: [1]}), pairs(spark, {1: [1]})
    assert E.precision_at_k(found, relevant, 1).first()[0] == 1.0
    assert E.precision_at_k(found, pairs(spark, {9: [1]}), 1).first()[0] == 0.0


def test_novelty_and_diversity(spark):
    popularity = spark.createDataFrame([(1, 4), (2, 1)], "track_id long, popularity_score long")
    assert E.novelty_at_k(recs(spark, {1: [1, 2, 7]}), popularity, 5).first()[0] == pytest.approx(4 / 3, abs=1e-6)
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "track_id long, track_group_id long")
    assert E.diversity_at_k(recs(spark, {1: [1, 2, 3]}), groups, 5).first()[0] == pytest.approx(2 / 3)
    assert E.diversity_at_k(recs(spark, {1: [1, 8], 2: [2]}), groups, 5).first()[0] == 1.0


def test_documents_and_comparison(spark, folder):
    found, relevant = recs(spark, {1: [1, 2]}), pairs(spark, {1: [1]})
    popularity = spark.createDataFrame([(1, 4)], "track_id long, popularity_score long")
    groups = spark.createDataFrame([(1, 1)], "track_id long, track_group_id long")
    row = E.evaluate(found, relevant, pairs(spark, {1: [1], 2: [1]}), popularity, groups, 2)
    assert (row.first().total_users, row.first().evaluated_users) == (2, 1)
    for model in ("als", "ranked"):
        document = tables.evaluation_document(row, model, 2, "2025-01-01")
        tables.write_evaluation(document, folder, model)
    text = spark.read.text(f"{folder}/evaluation_als.json").first()[0]
    assert '"metrics":{"k=2":{"precision@k":0.5,' in text
    compared = {r.model: r for r in E.compare_models(spark, folder).collect()}
    assert set(compared) == {"als", "ranked"}
    assert compared["als"].k == "k=2" and compared["als"].recall_at_k == 1.0
    with pytest.raises(FileNotFoundError):
        tables.read_evaluations(spark, folder, ["none"])
