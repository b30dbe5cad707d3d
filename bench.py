"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the input tables,
BENCH_CPUS (default 8) the local cores, BENCH_RUNS (default 2) the runs per
query, BENCH_QUERIES a comma-separated choice of queries. Every run writes the
whole result to a sink that discards it; the first run is a warm-up when there
are several, and the median of the others is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallymart.plans.queries import QUERIES  # noqa: E402
from tallymart.session import build_session  # noqa: E402

HEADLINES = (
    "rename_headers",
    "collapse_order_lines",
    "flag_returned",
    "star_orders",
    "star_customers",
    "star_products",
    "reconcile_counts",
    "profile_table",
    "dup_rows_all",
    "dup_rows_later",
    "load_overwrite",
    "merge_orders",
    "export_pipe_csv",
    "run_sql_script_join",
    "incremental_two_batches",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINES

    spark = build_session(
        "tallymart-bench",
        f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in chosen:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
