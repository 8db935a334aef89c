"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the number of local cores.
Each query runs three times (a stream once) and its best time counts; results go to a sink that
discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from skyledger.plans.registry import QUERIES
from skyledger.session import build_session

HEADLINE = [
    "delay_stats",
    "clean_flights",
    "land_flight_polls",
    "live_flight_status",
    "latest_positions",
    "status_transitions",
    "document_elements",
    "document_section_chunks",
    "short_section_chunks",
    "page_section_chunks",
    "nearest_to_label_centre",
    "change_feed",
    "current_state",
    "create_trips",
    "list_alerts",
    "match_alerts",
    "constraint_audit",
    "tool_outcomes",
    "alerts_per_hour",
    "most_watched_routes",
    "active_users_per_day",
    "latest_reply",
    "log_actions",
    "trip_flights",
    "scan_flight_csvs",
    "synced_index",
    "flight_status_event_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "skyledger-bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(1 if name.endswith("_stream") else 3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - start, 3))
        seconds[name] = min(runs)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
