"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3 timed runs after one warm-up).
Each query is written to the `noop` sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from usagelake.catalog import QUERIES
from usagelake.session import build_session

HEADLINE = (
    "latest_state", "collapse_device", "json_flatten", "content_hash", "scd2_customer", "interval_owner",
    "asof_previous", "within_session", "pair_start_end", "fill_forward", "neighbour_bounds", "missing_numbers",
    "duplicate_flags", "assign_sequence", "top_by_sum", "upsert_newer", "upsert_accumulate", "upsert_guarded",
    "reconcile_full", "accrual_summary", "role_join", "rules_fold", "visits", "subscriptions_live", "detail_lines",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "usagelake-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        measured = []
        for i in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                measured.append(time.perf_counter() - began)
        times[name] = round(statistics.median(measured), 4)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 4), "unit": "sec", "queries": times, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
