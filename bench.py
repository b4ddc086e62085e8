"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local
cores. Every query runs in full into a sink that discards its rows; the best of
``BENCH_RUNS`` runs counts, planning included.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyworks.plans.catalogue import catalogue  # noqa: E402

HEADLINE = [
    "roster_avg_mode", "roster_pct_below", "roster_top3",
    "roster_avg_mode_partitioned", "roster_pct_below_partitioned", "roster_top3_partitioned",
    "pig_avg_mode", "pig_pct_below", "pig_top3", "pig_all_reports",
    "dq_error_records", "warehouse_build", "anti_join_key", "anti_join_like",
    "word_count", "top_words",
    "cooc_pairs_d1", "cooc_pairs_d2", "cooc_pairs_d3", "cooc_pairs_d4",
    "cooc_pairs_line_agg", "cooc_stripes_d4", "cooc_distance_sweep",
    "stem_vocabulary", "document_frequency", "top_terms_by_df", "tfidf",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", tempfile.mkdtemp(prefix="bench-")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue()
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
