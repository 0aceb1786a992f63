"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma list to run others than the headline ones ("all" for every query)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from revrank.registry import QUERIES
from revrank.session import local_session

HEADLINE = [
    "enrich_interactions", "candidate_pairs", "exclude_seen", "user_stats", "item_stats", "coverage",
    "segment_category_pivot", "topk_cumcount", "last_n_history", "user_sequences", "prefix_target_samples",
    "ngram_counts", "target_encode", "undersample_negatives", "stratified_folds", "negative_sample_unseen",
    "lightgcn_propagate", "gat_propagate", "lambda_gradients", "dcg_revenue", "leaderboard_table", "roc_auc",
    "rec_price_constant", "rec_ngram_addk", "rec_ngram_backoff", "rec_popularity", "rec_content", "blocked_topk",
    "rec_logistic", "rec_random_forest", "rec_lambda_rank", "rec_sequence_pool", "rec_sequence_attention",
    "rec_lightgcn", "rec_gcn", "rec_gat", "stream_user_history", "stream_item_popularity",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    asked = os.environ.get("BENCH_QUERIES", "")
    chosen = list(QUERIES) if asked == "all" else (asked.split(",") if asked else HEADLINE)
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and the Python workers' machinery before the clock runs.
    QUERIES["topk_row_number"](spark, folder).write.format("noop").mode("overwrite").save()
    QUERIES["exclude_seen_after_topk"](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in chosen:
        start = time.perf_counter()
        try:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = str(e)[:200]
        print(f"{name} {times.get(name, 'failed')}", file=sys.stderr, flush=True)
    found = re.search(r"sf([\d.]+)", folder)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(found.group(1).rstrip(".")) if found else None,
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))


if __name__ == "__main__":
    main()
