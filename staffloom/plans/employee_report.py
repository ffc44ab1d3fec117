"""The enriched employee report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffloom import fixedvalues as V
from staffloom.functions import rules
from staffloom.functions.dates import Clock, complete_months, complete_years, now, today
from staffloom.operators.aggregates import recent_rejects, salary_statistics
from staffloom.operators.changes import with_one_row
from staffloom.operators.hotkeys import HOT_ROWS
from staffloom.operators.latest import latest_overall, latest_per_key
from staffloom.operators.lookup import lookup
from staffloom.operators.numbering import rank_in_groups
from staffloom.sources.workspace import Workspace


def latest_run(audit: DataFrame, status: str = V.RUN_STATUS) -> DataFrame:
    """At most one row: the last finished run with the status."""
    newest = [F.col("finished_at").desc(), F.col("started_at").desc(), F.col("run_id").desc()]
    return latest_overall(audit.filter(F.col("status") == status), newest)


def latest_enriched(enriched: DataFrame) -> DataFrame:
    """The newest version of every employee; of equal ones that of the highest run id."""
    newest = [F.col("loaded_at").desc(), F.col("etl_run_id").desc()]
    return latest_per_key(enriched, ["employee_id"], newest)


def employee_report(
    employees: DataFrame,
    departments: DataFrame,
    enriched: DataFrame,
    rejects: DataFrame,
    audit: DataFrame,
    ws: Workspace,
    as_of: Clock = None,
    as_of_ts: Clock = None,
    run_status: str = V.RUN_STATUS,
    reject_days: int = V.REPORT_REJECT_DAYS,
    statuses: Sequence[str] = V.REPORT_STATUSES,
    min_salary: float = V.REPORT_MIN_SALARY,
    min_months: int = V.REPORT_MIN_MONTHS,
    regions: Sequence[str] = (*V.REPORT_REGIONS, V.REPORT_REGION_OTHER),
    max_rejects: int = V.REPORT_MAX_REJECTS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per employee of interest beside the latest run; empty without a run.

    Ranks and quartiles are over all employees of a department, so every filter
    stays above them. What is known of a department, names and statistics, is settled first
    as one small table; its largest head count decides how the ranks are computed.
    """
    day = today(as_of)
    named = departments.select(
        "department_id",
        "department_name",
        "location",
        rules.report_region(F.col("location")).alias("geo_region"),
    )
    # Employees may name no department or an unknown one: those have statistics alone.
    places, largest = ws.settle_counted(
        named.join(salary_statistics(employees), "department_id", "full_outer"),
        "places",
        F.max("dept_employee_count"),
    )
    sources = ws.settle(recent_rejects(rejects, now(as_of_ts), reject_days), "recent-rejects")

    base = employees.select(
        "employee_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("employee_name"),
        F.lower("email").alias("email"),
        "department_id",
        "hire_date",
        F.col("salary").alias("current_salary"),
        "status",
        complete_years(F.col("hire_date"), day).alias("service_years"),
        complete_months(F.col("hire_date"), day).alias("service_months"),
    )
    newest = latest_enriched(enriched).select(
        "employee_id",
        F.col("normalized_email").alias("enriched_email"),
        F.col("salary").alias("enriched_salary"),
        "standardized_status",
        "salary_band",
        "compensation_index",
        "source_system",
        "source_employee_id",
    )
    facts = base.join(newest, "employee_id", "left").withColumns(
        {
            "effective_salary": F.coalesce("enriched_salary", "current_salary"),
            "effective_status": F.coalesce("standardized_status", "status"),
        }
    )
    ranked = rank_in_groups(
        ws.settle(facts, "facts"),
        "department_id",
        "effective_salary",
        "employee_id",
        ws,
        largest_group=largest,
        hot_rows=hot_rows,
    )
    wanted = ranked.filter(
        F.col("effective_status").isin(*statuses)
        & (F.col("effective_salary") >= min_salary)
        & (F.col("service_months") >= min_months)
    )
    joined = lookup(wanted, places, ["department_id"], "employee_id", hot_rows, employees)
    joined = joined.filter(F.col("geo_region").isin(*regions))
    joined = lookup(
        joined, sources, ["source_system", "source_employee_id"], "employee_id", hot_rows, enriched
    )
    joined = joined.filter(F.col("reject_count").isNull() | (F.col("reject_count") <= max_rejects))
    joined = joined.withColumn("source_quality_band", rules.quality_band(F.col("reject_count")))

    run = latest_run(audit, run_status).select(
        F.col("run_id").alias("latest_success_run_id"),
        F.col("started_at").alias("latest_run_started_at"),
        F.col("finished_at").alias("latest_run_finished_at"),
        F.col("source_row_count").alias("latest_run_source_rows"),
        F.col("rejected_row_count").alias("latest_run_rejected_rows"),
        F.col("loaded_row_count").alias("latest_run_loaded_rows"),
    )
    salary, years = F.col("effective_salary"), F.col("service_years")
    average = F.col("dept_avg_salary")
    report = with_one_row(joined, run).select(
        F.col("employee_id").alias("employee_key"),
        "employee_name",
        F.coalesce("enriched_email", "email").alias("normalized_email"),
        "department_id",
        "department_name",
        F.col("location").alias("department_location"),
        "geo_region",
        "hire_date",
        "service_years",
        "service_months",
        rules.tenure_class(years).alias("tenure_classification"),
        "effective_salary",
        "salary_band",
        rules.compensation_tier(salary).alias("compensation_tier"),
        F.col("value_rank").alias("dept_salary_rank"),
        F.col("value_tile").alias("dept_salary_quartile"),
        rules.percent_off_average(salary, average).alias("pct_vs_dept_avg"),
        "dept_avg_salary",
        "dept_min_salary",
        "dept_max_salary",
        "effective_status",
        rules.report_status(F.col("effective_status")).alias("status_label"),
        "compensation_index",
        "source_system",
        "source_employee_id",
        "source_quality_band",
        F.coalesce("reject_count", F.lit(0)).alias(f"reject_count_{reject_days}d"),
        "last_rejected_at",
        "reject_reasons",
        *run.columns,
        rules.salary_position(F.col("value_rank"), F.col("value_tile")).alias(
            "salary_position_label"
        ),
        rules.employee_action(years, salary, average, F.col("source_quality_band")).alias(
            "recommended_hr_action"
        ),
    )
    return report.orderBy(
        "geo_region", "department_name", F.col("effective_salary").desc(), "employee_name"
    )
