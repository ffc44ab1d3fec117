"""The department risk dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffloom import fixedvalues as V
from staffloom.functions import rules
from staffloom.functions.dates import Clock, complete_years, now, today
from staffloom.operators.aggregates import department_measures, rank_departments, recent_rejects
from staffloom.operators.changes import with_one_row
from staffloom.operators.hotkeys import HOT_ROWS
from staffloom.operators.lookup import lookup
from staffloom.plans.employee_report import latest_enriched, latest_run
from staffloom.sources.workspace import Workspace


def employee_facts(
    employees: DataFrame,
    enriched: DataFrame,
    rejects: DataFrame,
    day: Column,
    moment: Column,
    reject_days: int,
    ws: Workspace,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per employee what the measures read: enriched values, base ones where absent.

    Rejects belong to the source record, so employees that share one each count them.
    """
    sources = ws.settle(recent_rejects(rejects, moment, reject_days), "recent-rejects")
    base = employees.select(
        "employee_id",
        "department_id",
        F.col("salary").alias("_salary"),
        F.col("status").alias("_status"),
        complete_years(F.col("hire_date"), day).alias("years"),
    )
    newest = latest_enriched(enriched).select(
        "employee_id",
        "salary",
        "standardized_status",
        "salary_band",
        "tenure_bucket",
        "source_system",
        "source_employee_id",
    )
    joined = base.join(newest, "employee_id", "left")
    joined = lookup(
        joined, sources, ["source_system", "source_employee_id"], "employee_id", hot_rows, enriched
    )
    return joined.select(
        "employee_id",
        "department_id",
        "years",
        F.coalesce("salary", "_salary").alias("salary"),
        F.coalesce("standardized_status", "_status").alias("status"),
        F.coalesce("salary_band", rules.salary_band(F.col("_salary"))).alias("band"),
        F.coalesce("tenure_bucket", rules.tenure_bucket(F.col("years"))).alias("bucket"),
        "reject_count",
        "last_rejected_at",
    )


def score_departments(
    measures: DataFrame, ws: Workspace, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Ranks, risk score, risk band and recommended action per department."""
    score = rules.risk_score(
        F.col("total_rejects"),
        F.col("active_ratio_pct"),
        F.col("early_tenure_pct"),
        F.col("salary_stddev"),
    )
    ranked = rank_departments(measures, ws, hot_rows).withColumn("risk_score_raw", score)
    return ranked.withColumns(
        {
            "risk_band": rules.risk_band(F.col("risk_score_raw")),
            "recommended_action": rules.department_action(
                F.col("rank_by_data_rejects"),
                F.col("rank_by_low_activity"),
                F.col("early_tenure_pct"),
            ),
        }
    )


def department_dashboard(
    employees: DataFrame,
    departments: DataFrame,
    enriched: DataFrame,
    rejects: DataFrame,
    audit: DataFrame,
    ws: Workspace,
    as_of: Clock = None,
    as_of_ts: Clock = None,
    run_status: str = V.RUN_STATUS,
    reject_days: int = V.DASHBOARD_REJECT_DAYS,
    min_employees: int = V.DASHBOARD_MIN_EMPLOYEES,
    min_active_ratio_pct: float = V.DASHBOARD_MIN_ACTIVE_PCT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per department at risk beside the latest run; empty without a run.

    The default `min_active_ratio_pct` is above any percentage, so with it the
    result is empty; pass a reachable one.
    """
    facts = employee_facts(
        employees, enriched, rejects, today(as_of), now(as_of_ts), reject_days, ws, hot_rows
    )
    # Employees are summed up per department before names and places are looked up.
    places = departments.select(
        "department_id",
        "department_name",
        "location",
        rules.dashboard_region(F.col("location")).alias("geo_cluster"),
    )
    scored = score_departments(department_measures(facts), ws, hot_rows).filter(
        (F.col("total_employees") >= min_employees)
        & (F.col("active_ratio_pct") >= min_active_ratio_pct)
        & F.col("risk_band").isin(*[band for _, band in V.RISK_BANDS])
    )
    named = scored.join(places, "department_id", "left").withColumns(
        {
            "department_name": F.coalesce("department_name", F.lit("Unknown")),
            "location": F.coalesce("location", F.lit("N/A")),
            "geo_cluster": F.coalesce("geo_cluster", F.lit(V.DASHBOARD_REGION_UNKNOWN)),
        }
    )
    run = latest_run(audit, run_status).select(
        F.col("run_id").alias("latest_run_id"),
        F.col("started_at").alias("latest_run_start"),
        F.col("finished_at").alias("latest_run_end"),
        "source_row_count",
        "rejected_row_count",
        "loaded_row_count",
    )
    rounded = [
        F.round(c, 2).cast("decimal(20,2)").alias(c)
        for c in ("avg_salary", "min_salary", "max_salary", "salary_stddev")
    ]
    dashboard = with_one_row(named, run).select(
        "department_id",
        "department_name",
        "location",
        "geo_cluster",
        "total_employees",
        "active_employees",
        "on_leave_employees",
        "inactive_employees",
        "active_ratio_pct",
        *rounded,
        F.round("avg_years_of_service", 2).cast("decimal(20,2)").alias("avg_years_of_service"),
        "high_band_count",
        "high_salary_band_pct",
        "early_tenure_count",
        "early_tenure_pct",
        F.col("total_rejects").alias(f"total_rejects_{reject_days}d"),
        "last_reject_time",
        "rank_by_avg_salary",
        "rank_by_data_rejects",
        "rank_by_low_activity",
        "risk_score_raw",
        "risk_band",
        "recommended_action",
        *run.columns,
        rules.reject_rate(F.col("rejected_row_count"), F.col("source_row_count")).alias(
            "latest_reject_rate_pct"
        ),
    )
    return dashboard.orderBy(
        F.col("risk_score_raw").desc(),
        F.col(f"total_rejects_{reject_days}d").desc(),
        F.col("avg_salary").desc(),
        "department_name",
    )
