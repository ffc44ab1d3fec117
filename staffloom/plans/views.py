"""The named views and the sample selects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffloom import fixedvalues as V
from staffloom.functions.dates import Clock
from staffloom.functions.scalar import employee_tenure
from staffloom.operators.lookup import lookup
from staffloom.sources.tables import publish_view


def with_department(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Employees that have a department, with its name."""
    named = departments.select("department_id", "department_name", F.lit(True).alias("_known"))
    found = lookup(employees, named, ["department_id"], "employee_id")
    return found.filter("_known").drop("_known")


def active_employees(
    employees: DataFrame, departments: DataFrame, status: str = V.VIEW_STATUS
) -> DataFrame:
    wanted = employees.filter(F.col("status") == status)
    return (
        with_department(wanted, departments)
        .select(
            "employee_id",
            "first_name",
            "last_name",
            "email",
            "salary",
            "department_name",
            "hire_date",
        )
        .orderBy("last_name", "first_name", "employee_id")
    )


def salary_summary(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Per department: employees are summed up first, then named."""
    summed = employees.groupBy("department_id").agg(
        F.count("employee_id").alias("employee_count"),
        F.avg("salary").alias("avg_salary"),
        F.min("salary").alias("min_salary"),
        F.max("salary").alias("max_salary"),
        F.sum("salary").alias("total_salary"),
    )
    return summed.join(departments, "department_id").select(
        "department_name",
        "employee_count",
        "avg_salary",
        "min_salary",
        "max_salary",
        "total_salary",
    )


def employee_details(
    employees: DataFrame, departments: DataFrame, as_of: Clock = None
) -> DataFrame:
    return with_department(employees, departments).select(
        "employee_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "salary",
        employee_tenure(F.col("hire_date"), as_of).alias("tenure_years"),
        "department_name",
    )


def publish_views(employees: DataFrame, departments: DataFrame, as_of: Clock = None) -> None:
    """Register the three views by name for SQL."""
    publish_view(active_employees(employees, departments), "active_employees_view")
    publish_view(salary_summary(employees, departments), "employee_salary_summary")
    publish_view(employee_details(employees, departments, as_of), "employee_details_with_tenure")


def high_earners(employees: DataFrame, above: float = V.HIGH_EARNER_SALARY) -> DataFrame:
    return (
        employees.filter(F.col("salary") > above)
        .select("employee_id", "first_name", "last_name", "salary")
        .orderBy(F.col("salary").desc(), "employee_id")
    )


def large_groups(
    employees: DataFrame, key: str = "department_id", more_than: int = V.HAVING_MORE_THAN
) -> DataFrame:
    return (
        employees.groupBy(key)
        .agg(F.count(F.lit(1)).alias("employee_count"), F.avg("salary").alias("avg_salary"))
        .filter(F.col("employee_count") > more_than)
    )


def employee_departments(employees: DataFrame, departments: DataFrame) -> DataFrame:
    return with_department(employees, departments).select(
        "employee_id", "first_name", "department_name"
    )
