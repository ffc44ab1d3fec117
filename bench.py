"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from staffloom.registry import QUERIES  # noqa: E402
from staffloom.session import local_session  # noqa: E402

HEADLINE = (
    "salary_summary",
    "employee_tenure",
    "active_employees",
    "dept_having",
    "band_rules",
    "dept_salary_stats",
    "reject_stats",
    "latest_enriched",
    "dept_rank_quartile",
    "dept_rank_quartile_sliced",
    "dept_avg_window",
    "source_key_lookup",
    "stg_validated",
    "stg_survivors",
    "stg_rejects",
    "new_departments",
    "employee_final",
    "employees_upsert",
    "target_upsert",
    "update_bulk",
    "delete_conj",
    "batch_hire",
    "salary_audit",
    "check_keys",
    "check_nulls",
    "department_dashboard",
    "employee_report",
)


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("staffloom-bench", os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]]
    timed(spark, "employee_report", folder)
    seconds = {n: round(statistics.median(timed(spark, n, folder) for _ in range(runs)), 3)
               for n in names}
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
