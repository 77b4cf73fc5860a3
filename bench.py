"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores) and
BENCH_QUERIES (comma-separated names, default the headline list). Tables shared by the queries
(items, events, split, factor model) are prepared first and timed on their own as ``prepare``.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crossfade.plans import registry  # noqa: E402
from crossfade.session import local_session  # noqa: E402

HEADLINE = [
    "standardize_text", "clean_name", "items", "item_catalog", "quantile_threshold",
    "events", "user_encoder", "item_encoder", "date_threshold", "train_events",
    "split_stats", "interaction_matrix", "data_summary", "pop_listen_count", "pop_user_count",
    "top_popular", "recommend_popular", "track_features", "merge_candidates", "labels",
    "sample_negatives", "rerank_multi_objective", "als_factors", "als_recs", "als_similar",
    "ranker_training_data", "rank_with_model", "all_metrics", "evaluate_popularity",
    "evaluate_als", "offline_recs", "similar_cosine", "online_recs", "blend", "recent_events",
    "recent_events_stream", "blend_stream", "top_genres",
]
SHARED = [
    "items", "catalog", "events", "user_encoder", "item_encoder", "train_events", "test_events",
    "train_matrix", "popularity", "top_popular", "popular_recs", "als_model", "personal_als", "ranker",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.time()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.time() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session("crossfade-bench", cpus)
    queries = registry.queries()

    prepared = {}
    shared = registry.stages(spark, sf_dir)
    for name in SHARED:
        start = time.time()
        getattr(shared, name)
        prepared[name] = round(time.time() - start, 3)
    times = {name: run(queries[name], spark, sf_dir) for name in names}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "prepare": prepared,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
