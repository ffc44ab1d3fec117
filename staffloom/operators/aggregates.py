"""Aggregate bundles. Each is one `groupBy`, so Spark aggregates on the map side
first and a hot group costs no more than a small one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffloom import fixedvalues as V
from staffloom.functions import rules
from staffloom.functions.dates import days_before
from staffloom.operators.hotkeys import HOT_ROWS
from staffloom.operators.numbering import dense_ranks
from staffloom.sources.workspace import Workspace


def count_if(test: Column) -> Column:
    return F.sum(F.when(test, F.lit(1)).otherwise(F.lit(0)))


def ordered_list(value: Column, separator: str = V.REASON_SEPARATOR) -> Column:
    """The distinct values in order, joined to one text."""
    return F.array_join(F.array_sort(F.collect_set(value)), separator)


def salary_statistics(employees: DataFrame) -> DataFrame:
    """Head count and salary spread per department; no department is a group too."""
    return employees.groupBy("department_id").agg(
        F.count(F.lit(1)).alias("dept_employee_count"),
        F.avg("salary").alias("dept_avg_salary"),
        F.min("salary").alias("dept_min_salary"),
        F.max("salary").alias("dept_max_salary"),
        F.stddev_pop("salary").alias("dept_salary_stddev"),
    )


def recent_rejects(rejects: DataFrame, now: Column, days: int) -> DataFrame:
    """Per source record: rejects of the last `days` days, the last one, the reasons."""
    return (
        rejects.filter(F.col("rejected_at") >= days_before(now, days))
        .groupBy("source_system", "source_employee_id")
        .agg(
            F.count(F.lit(1)).alias("reject_count"),
            F.max("rejected_at").alias("last_rejected_at"),
            ordered_list(F.col("rejection_reason")).alias("reject_reasons"),
        )
    )


def department_measures(facts: DataFrame) -> DataFrame:
    """Sixteen measures per department in one pass over the employee facts.

    Reads department_id, salary, status, band, bucket, years, reject_count and
    last_rejected_at.
    """
    status = F.upper("status")
    n = F.col("total_employees")
    summed = facts.groupBy("department_id").agg(
        F.count(F.lit(1)).alias("total_employees"),
        count_if(status == "ACTIVE").alias("active_employees"),
        count_if(status == "ON LEAVE").alias("on_leave_employees"),
        count_if(status == "INACTIVE").alias("inactive_employees"),
        F.avg("salary").alias("avg_salary"),
        F.min("salary").alias("min_salary"),
        F.max("salary").alias("max_salary"),
        F.stddev_pop("salary").cast("decimal(20,6)").alias("salary_stddev"),
        F.avg(F.col("years").cast("decimal(10,0)")).alias("avg_years_of_service"),
        count_if(F.col("band").isin(*V.HIGH_BANDS)).alias("high_band_count"),
        count_if(F.col("bucket").isin(*V.EARLY_BUCKETS)).alias("early_tenure_count"),
        F.sum(F.coalesce("reject_count", F.lit(0))).alias("total_rejects"),
        F.max("last_rejected_at").alias("last_reject_time"),
    )
    return summed.withColumns(
        {
            "active_ratio_pct": rules.percent_of(F.col("active_employees"), n),
            "high_salary_band_pct": rules.percent_of(F.col("high_band_count"), n),
            "early_tenure_pct": rules.percent_of(F.col("early_tenure_count"), n),
        }
    )


def rank_departments(
    measures: DataFrame, ws: Workspace, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Three ranks over all departments.

    The measures, one row per department, are settled and counted; up to `hot_rows`
    departments are ranked in one task, more by ranges of the different values.
    """
    measures, rows = ws.settle_counted(measures, "department-measures")
    falling = {
        "rank_by_avg_salary": F.col("avg_salary"),
        "rank_by_data_rejects": F.col("total_rejects"),
        "rank_by_low_activity": -F.col("active_ratio_pct"),
    }
    if rows > hot_rows:
        return dense_ranks(measures, falling, "department_id", ws, hot_rows)
    return measures.withColumns(
        {
            name: F.dense_rank().over(Window.orderBy(value.desc()))
            for name, value in falling.items()
        }
    )
