"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores; BENCH_QUERIES (comma separated) narrows the list.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ingest_parquet",
    "dedup_latest",
    "dead_letter",
    "ingestion_stats",
    "merge_upsert",
    "write_partitioned",
    "customer_features",
    "demand_features",
    "rolling_demand",
    "lookback_aggregates",
    "quantile_bounds",
    "churn_preparation",
    "demand_preparation",
    "rf_classifier",
    "eval_roc_auc",
    "eval_f1_weighted",
    "clean_text",
    "tokenize",
    "gazetteer_entities",
    "extraction_result",
    "classify_documents",
    "score_lookup",
    "score_with_store",
    "latency_histogram",
    "psi_drift",
    "stream_ingest",
]


def main() -> None:
    from brightwater import plans
    from brightwater.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        **{"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.all_queries()
    queries["predictions_total"](spark, sf_dir).collect()  # starts the JVM's threads and code cache
    seconds = {}
    for name in chosen:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
