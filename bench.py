"""Time the headline queries and print one JSON line.

Derived tables (the stored series and items) are built first and reported as ``load_*``; every
query then runs once, its whole result going to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = """
velocity_pairs latest_stats endpoints channel_recent_avg rank_velocity metadata_latest viral_series
target_window_pairs flexible_pairs stats_with_metadata recent_stats reference_sample due_followups
top_percentile exact_quantiles top_terms newest_50 title_features clean_text tag_list date_features
engagement growth video_id number_format velocity_features viral_features clickbait_features
anomaly_features genre_corpus evaluation_features classification_metrics regression_metrics histogram
paired_histogram correlation_matrix ks_statistic integrity_report frequent_itemsets association_rules
tag_recommendations tfidf ingest_video_items insert_if_absent append_stats stream_snapshots
stream_upsert stream_endpoints stream_daily_summary train_velocity train_anomaly score_anomaly
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from countertide.catalog import REGISTRY
    from countertide.session import build_session
    from countertide.sources.bindings import Tables

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}

    def timed(name, work):
        began = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - began, 3)

    tables = Tables(spark, folder)
    timed("load_stats", tables.stats)
    timed("load_videos", tables.videos)
    for name in chosen:
        timed(name, lambda q=REGISTRY[name]: q(spark, folder).write.format("noop").mode("overwrite").save())
    line = {
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
