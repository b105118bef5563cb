"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from ringspan.plans.catalog import QUERIES
from ringspan.session import local_session

HEADLINE = (
    "active_distinct_30s",
    "active_calls_30s",
    "active_pairs_30s",
    "active_pairs_300s",
    "active_interval_rows",
    "starts_by_window_id",
    "starts_per_window",
    "open_at_window_end",
    "pair_all_after",
    "pair_first_after",
    "idle_next_mono_60s",
    "idle_next_bi_60s",
    "idle_next_bi_900s",
    "idle_lag_mono_30s",
    "idle_lag_bi_30s",
    "watermark_snapshots",
    "watermark_snapshots_started",
    "sequence_id_mono",
    "latency_summary",
    "stream_active_distinct",
    "stream_open_at_end",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, name="ringspan-bench")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    run("starts_by_window_id")  # JVM and file listing
    times = {}
    for name in names:
        # The better of two runs; streams once, they are dominated by fixed micro-batch costs.
        runs = 1 if name.startswith("stream_") else 2
        times[name] = min(run(name) for _ in range(runs))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "call analytics, sum of query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
