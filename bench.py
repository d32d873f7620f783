"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Per query: one warm-up run, then the median of three runs, each written to
the ``noop`` sink (the whole result is computed, nothing is collected).
Building the DataFrame is inside the timing, since some operators
checkpoint eagerly. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "resolution_share", "count_by_category", "top3_detail", "item_rating_stats", "feature_ctr",
    "nunique_columns", "describe_numeric", "ks_two_sample", "roc_points", "auc_rank", "threshold_sweep",
    "dense_row_id", "user_knn", "item_knn", "jaccard_pairs", "lag_windows", "tfidf_long", "word_count",
    "count_idf_long", "doc_cosine", "knn_classify", "als_predict", "ape_naive", "kmeans_elbow", "lda_online",
    "intake_item_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    # local mode: the driver JVM is the whole cluster; give it half the box
    os.environ.setdefault("KILN_DRIVER_MEMORY", os.environ.get("BENCH_MEMORY", "16g"))
    from kiln.plans import catalog
    from kiln.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="kiln-bench")
    times = {}
    for name in names:
        fn = catalog.QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
