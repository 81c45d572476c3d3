"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run once on the smallest data to warm the JVM up, then timed once on the whole tables, with all rows
produced (no-op sink). Nothing is cached between queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from checks.registry import QUERIES
from turnlake.session import local_session

HEADLINES = (
    "chat_turn_pairs", "nested_turn_pairs", "arena_events", "prompt_library_events", "prompt_features",
    "document_features", "prompt_validity_report", "stage_hygiene", "dim_prompt", "warehouse_load", "stream_load",
    "stream_daily_counts", "daily_model_success", "arena_model_performance", "language_performance", "feature_impact",
    "top_templates", "model_efficiency", "model_board", "feature_board", "timeline_pivot", "feature_correlation",
    "latency_quantiles", "training_features", "train_split_counts", "association_rules", "regression_metrics",
    "roc_points", "heuristic_scores", "what_if_text", "what_if_features",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    small = f"{Path(folder).parent}/sf0.001"
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINES

    def run(name: str, data: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        if Path(small).is_dir():
            run(name, small)
        seconds[name] = round(run(name, folder), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "total time of the headline queries", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
