"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query, the fastest counts), BENCH_QUERIES (comma-separated
names, or "all").
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "rate_per_million",
    "rate_per_million_stored_rollup",
    "spend_by_function",
    "hourly_spend",
    "hourly_rollup_sql",
    "kpis",
    "assistant_by_user_model",
    "spend_by_user",
    "spend_by_role",
    "spend_by_tag_key_team",
    "top_calls",
    "tag_coverage",
    "model_tiers",
    "duplicate_calls_by_user",
    "prompt_trend",
    "high_token_calls",
    "idle_services",
    "cleanup_candidates",
    "heavy_call_users",
    "week_over_week",
    "user_weekly_spike",
    "report_summary",
    "estimate_batch",
    "dedupe_inputs_mapping",
    "prompt_filler_scan",
    "enrich_new_rows",
    "rolling_cap",
    "budget_burn_by_team",
    "budget_burn_month_to_date",
    "run_budget",
    "role_grant_check",
    "stream_hourly_spend",
    "stream_rolling_cap",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spend-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "5g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from checks.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times, cold = {}, {}
    for name in names:
        cold[name] = round(once(name), 3)
        times[name] = round(min(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": cold,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
