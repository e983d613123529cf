"""Wall time of the headline queries, one JSON line on stdout.

Each query is written to the no-op sink, so all its columns are computed; the first run warms up,
the median of the further ones counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from modelpulse.plans.catalogue import QUERIES
from modelpulse.session import get_spark

HEADLINE = [
    "endpoint_request_summary",
    "duration_histogram",
    "active_requests_gauge",
    "fifo_batches",
    "latency_slo",
    "run_throughput",
    "load_step_profile",
    "top_predictions",
    "batched_scores",
    "span_summary",
    "request_traces",
    "notebook_image_names",
    "stratified_split",
    "stratified_folds",
    "classification_report",
    "area_under_roc",
    "best_gini_splits",
    "linear_models",
    "point_in_time_features",
    "validation_report",
    "stability_index",
    "distribution_shift",
    "document_chunks",
    "lexical_search",
    "vector_search",
    "hybrid_search",
    "model_bleu",
    "live_request_metrics",
]
# Costly ones, run once after the headline and reported beside its total.
COSTLY = ["two_stage_search", "retrieval_quality", "semantic_cache", "quantised_vector_search", "tree_scores", "streamed_medallion_gold"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark(
        "modelpulse-bench",
        f"local[{cpus}]",
        **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - began
        spark.catalog.clearCache()
        return taken

    seconds = {}
    for name in HEADLINE:
        taken = [timed(name) for _ in range(runs + 1)]
        seconds[name] = round(statistics.median(taken[1:]), 3)
    costly = {name: round(timed(name), 3) for name in COSTLY} if runs else {}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "costly": costly,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
