"""The two scalar functions, as column builders and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from staffloom import fixedvalues as V
from staffloom.functions.dates import Clock, calendar_years, today


def employee_tenure(hire_date: Column, as_of: Clock = None) -> Column:
    return calendar_years(hire_date, today(as_of))


def bonus(
    salary: Column,
    rating: Column,
    rates: tuple = V.BONUS_RATES,
    other_rate: str = V.BONUS_OTHER_RATE,
) -> Column:
    """Yearly bonus in whole units: the salary is rounded, then the product is."""
    rate = F.coalesce(
        *[F.when(rating >= least, F.lit(r).cast("decimal(3,2)")) for least, r in rates],
        F.lit(other_rate).cast("decimal(3,2)"),
    )
    return F.round(salary.cast("decimal(10,0)") * rate, 0).cast("decimal(10,0)")


def register_functions(spark: SparkSession) -> None:
    """Make both available to SQL text as temporary SQL functions."""
    rates = " ".join(f"WHEN rating >= {least} THEN {rate}" for least, rate in V.BONUS_RATES)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION employee_tenure(hire_date DATE, as_of DATE) "
        "RETURNS INT RETURN year(as_of) - year(hire_date)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION employee_bonus(salary DECIMAL(10,0), rating INT) "
        "RETURNS DECIMAL(10,0) RETURN CAST(round(salary * CASE "
        f"{rates} ELSE {V.BONUS_OTHER_RATE} END, 0) AS DECIMAL(10,0))"
    )
