"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

All queries run in turn, $BENCH_RUNS rounds (default 4), into the no-op sink, so every row and
column is computed. The first round is reported as such; the best of the others counts. Queries
that load files are timed as a whole, from landing to the table they fill.
"""

from __future__ import annotations

import json
import os
import sys
import time

from hourledger.plans.queries import QUERIES
from hourledger.session import build_session

HEADLINE = [
    "billable_hours_by_user",
    "billable_entries",
    "users_std",
    "hours_std",
    "dedupe_latest",
    "dedupe_latest_lineitem",
    "merge_latest",
    "merge_latest_small",
    "merge_into_std_table",
    "qa_consistency",
    "count_distinct_row",
    "dashboard_kpis",
    "hours_with_email",
    "display_users",
    "user_series",
    "latest_issuer",
    "user_id_by_email",
    "invoice_fields",
    "invoice_rules",
    "invoice_hours_mtd",
    "invoice_decisions",
    "invoice_store_roundtrip",
    "api_pages_flatten",
    "incremental_raw",
]


def run_once(spark, build, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "4"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()

    rounds = [{name: run_once(spark, QUERIES[name], sf_dir) for name in names} for _ in range(max(runs, 2))]
    first = {name: round(rounds[0][name], 3) for name in names}
    best = {name: round(min(times[name] for times in rounds[1:]), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
