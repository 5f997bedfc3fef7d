"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local
threads (default 8). Every query runs twice into a sink that drops the rows;
the faster run counts, so that code generation and class loading do not.
"""

from __future__ import annotations

import json
import os
import time

from txsieve.plans.catalog import QUERIES
from txsieve.session import build_session

HEADLINE = [
    "window_stats",
    "window_stats_orders",
    "winsorize_p99",
    "zscore_features",
    "iforest_fit",
    "iforest_score",
    "score_report",
    "train_report",
    "flatten_tx",
    "explain_anomaly",
    "kpi_cards",
    "hourly_stacked",
    "score_histogram",
    "recent_table",
    "model_metrics",
    "scores_join",
    "stream_raw_enrich",
    "stream_window_stats",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
