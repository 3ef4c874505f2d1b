"""Times the headline queries over whole tables and prints one JSON line.

    BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dialoom.plans.queries import QUERIES  # noqa: E402
from dialoom.session import build_session  # noqa: E402

HEADLINE = [
    "sft_text",
    "render_per_config",
    "render_chat",
    "extract_response",
    "prompt_history",
    "response_spans",
    "pack_wrapped",
    "pack_wrapped_global",
    "length_grouped_batches",
    "exact_match_mean",
    "pair_runs",
    "compare_all",
    "evaluate_runs",
    "segment_log",
    "replay_log",
    "merge_config",
    "prepare_dataset",
    "dataset_metrics",
    "stream_assemble",
    "stream_tags",
    "stream_replay",
    "stream_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)  # loads classes and compiles the generated code
        seconds[name] = round(min(run(name) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
