"""Each rule on its boundary values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from staffloom.functions import cleaning, dates, rules, scalar


def results(spark, rule, values, dtype):
    rows = [(i, None if v is None else str(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select(
        "i", rule(F.col("v").cast(dtype)).alias("out")
    )
    return [r.out for r in df.orderBy("i").collect()]


SALARIES = [None, 0, "39999.99", 40000, "69999.99", 70000, "99999.99", 100000, 149999, 150000]


@pytest.mark.parametrize(
    ("rule", "labels"),
    [
        (rules.salary_band, ["L1", "L2", "L3", "L4", "L5"]),
        (
            rules.compensation_tier,
            ["Entry", "Associate", "Specialist", "Lead", "Executive"],
        ),
    ],
)
def test_salary_labels(spark, rule, labels):
    a, b, c, d, e = labels
    assert results(spark, rule, SALARIES, "decimal(10,2)") == [e, a, a, b, b, c, c, d, d, e]


@pytest.mark.parametrize(
    ("rule", "years", "labels"),
    [
        (
            rules.tenure_bucket,
            [None, -1, 1, 2, 4, 5, 9, 10],
            ["10y+", "0-1y", "0-1y", "2-4y", "2-4y", "5-9y", "5-9y", "10y+"],
        ),
        (
            rules.tenure_class,
            [None, 1, 2, 4, 5, 9, 10],
            ["Long Tenure", "New Hire"]
            + ["Growing Contributor"] * 2
            + ["Experienced Core"] * 2
            + ["Long Tenure"],
        ),
        (
            rules.tenure_stage,
            [None, 1, 2, 6, 7, 12, 13],
            ["Legacy Expert", "Early Career"]
            + ["Mid Career"] * 2
            + ["Senior Core"] * 2
            + ["Legacy Expert"],
        ),
    ],
)
def test_tenure_labels(spark, rule, years, labels):
    assert results(spark, rule, years, "int") == labels


def test_quality_band(spark):
    assert results(spark, rules.quality_band, [None, 0, 1, 2, 3, 5, 6], "bigint") == [
        "Clean Feed",
        "Severe Data Issues",
        "Minor Data Issues",
        "Minor Data Issues",
        "Moderate Data Issues",
        "Moderate Data Issues",
        "Severe Data Issues",
    ]


def test_standard_status(spark):
    words = ["true", "a", "1", "n", "0", "paused", "ON_leave", None, "zzz", ""]
    assert results(spark, cleaning.standard_status, words, "string") == [
        "Active",
        "Active",
        "Active",
        "Inactive",
        "Inactive",
        "On Leave",
        "On Leave",
        "Active",
        "Active",
        "Active",
    ]


def test_regions(spark):
    places = ["NYC", "Bay Area", "amsterdam", "Delhi", None, "  ", "Dubai"]
    assert results(spark, rules.report_region, places, "string") == [
        "US-East",
        "US-West",
        "Europe",
        "India",
        "Unknown Region",
        "Unknown Region",
        "Other Region",
    ]
    assert results(spark, rules.dashboard_region, places, "string") == [
        "North America - East",
        "North America - West",
        "Europe Cluster",
        "India Cluster",
        "Unknown Geography",
        "Unknown Geography",
        "Other Geography",
    ]


def test_status_labels(spark):
    words = ["Active", "INACTIVE", "on leave", None, "gone"]
    assert results(spark, rules.report_status, words, "string") == [
        "Working",
        "Separated",
        "Temporarily Away",
        "Unknown Status",
        "Unknown Status",
    ]
    assert results(spark, rules.dashboard_status, words, "string")[2:4] == [
        "Employee is on Leave",
        "Employee status Unknown",
    ]


def test_read_date(spark):
    raw = ["2020-01-15", "15/01/2020", "01-15-2020", "2020/01/15", "2024-02-30", "31/02/2020",
           "13-15-2020", "", None, "x2020-01-15"]
    day = dt.date(2020, 1, 15)
    assert results(spark, cleaning.read_date, raw, "string") == [day] * 3 + [None] * 7


def test_read_salary(spark):
    raw = ["$1,200.50", "12.345", "-5", "123456789.00", "n/a", "50000", "1.5", "", None, "1e5"]
    assert results(spark, cleaning.read_salary, raw, "string") == [
        Decimal("1200.50"),
        None,
        Decimal("-5.00"),
        None,
        None,
        Decimal("50000.00"),
        Decimal("1.50"),
        None,
        None,
        None,
    ]


def test_read_department_id(spark):
    raw = ["12", "x", "-1", "99999999999999999999", None, ""]
    assert results(spark, cleaning.read_department_id, raw, "string") == [12] + [None] * 5


def test_bonus(spark):
    df = spark.createDataFrame(
        [(0, "70000", 5), (1, "70000", 4), (2, "70000", 3), (3, "70000", 2), (4, "70000", None),
         (5, "10.50", 3), (6, None, 4)],
        "i int, s string, r int",
    )
    scalar.register_functions(spark)
    out = df.select(
        "i",
        scalar.bonus(F.col("s").cast("decimal(10,2)"), F.col("r")).alias("b"),
        F.expr("employee_bonus(CAST(s AS DECIMAL(10,2)), r)").alias("q"),
    ).orderBy("i").collect()
    assert [r.b for r in out] == [10500, 10500, 7000, 17500, 17500, 1, None]
    assert [r.q for r in out] == [r.b for r in out]


def test_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-31", "2024-02-29"), ("2020-02-29", "2021-02-28"), ("2000-01-01", "2002-01-01"),
         ("2000-01-02", "2002-01-01")],
        "a string, b string",
    ).select(F.col("a").cast("date"), F.col("b").cast("date"))
    out = df.select(
        dates.complete_months(F.col("a"), F.col("b")).alias("m"),
        dates.complete_years(F.col("a"), F.col("b")).alias("y"),
        dates.calendar_years(F.col("a"), F.col("b")).alias("c"),
    ).collect()
    assert [(r.m, r.y, r.c) for r in out] == [(0, 0, 0), (11, 0, 1), (24, 2, 2), (23, 1, 2)]


def test_months_and_years_agree_with_spark_in_utc(spark):
    days = spark.range(0, 4000, 37).select(
        F.date_add(F.lit("1996-01-01").cast("date"), F.col("id").cast("int")).alias("a")
    )
    pairs = days.crossJoin(days.withColumnRenamed("a", "b"))
    a, b = F.col("a"), F.col("b")
    wrong = pairs.filter(
        (dates.complete_months(a, b) != F.timestamp_diff("MONTH", a, b))
        | (dates.complete_years(a, b) != F.timestamp_diff("YEAR", a, b))
    )
    assert pairs.count() > 10_000 and wrong.count() == 0


def test_no_month_is_lost_to_a_missing_midnight(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        start, end = F.lit("2000-10-08").cast("date"), F.lit("2001-10-08").cast("date")
        row = spark.range(1).select(
            dates.complete_months(start, end), dates.complete_years(start, end)
        )
        assert tuple(row.first()) == (12, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_days_before_keeps_the_time(spark):
    cut = dates.days_before(dates.now("2024-01-31 10:30:00"), 90)
    assert spark.range(1).select(cut).first()[0] == dt.datetime(2023, 11, 2, 10, 30)


def test_compensation_index(spark):
    df = spark.createDataFrame(
        [(None, "5"), ("5", "0"), ("1", "3"), ("2", "3"), ("5", None)], "s string, a string"
    )
    out = df.select(
        rules.compensation_index(
            F.col("s").cast("decimal(10,2)"), F.col("a").cast("decimal(14,6)")
        ).alias("x")
    ).collect()
    assert [r.x for r in out] == [0, None, Decimal("0.3333"), Decimal("0.6667"), None]


def test_percentages(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (0, 5), (1, 0), (1, None)], "p int, w int")
    out = df.select(
        rules.percent_of(F.col("p"), F.col("w")).alias("pct"),
        rules.reject_rate(F.col("p"), F.col("w")).alias("rate"),
    ).collect()
    assert [r.pct for r in out] == [Decimal("33.33"), Decimal("66.67"), 0, None, None]
    assert [r.rate for r in out] == [Decimal("33.33"), Decimal("66.67"), 0, 0, 0]


def test_percent_off_average(spark):
    df = spark.createDataFrame([("150", "100"), ("50", "100"), ("5", "0")], "s string, a string")
    out = df.select(
        rules.percent_off_average(
            F.col("s").cast("decimal(10,2)"), F.col("a").cast("decimal(14,6)")
        ).alias("x")
    ).collect()
    assert [r.x for r in out] == [50, -50, None]


@pytest.mark.parametrize(
    ("inputs", "score"),
    [
        ((20, 64.99, 60.01, 35000.01), 105),
        ((19, 65, 60, 35000), 25 + 20 + 12 + 10),
        ((10, 79.99, 40.01, 20000.01), 25 + 20 + 12 + 10),
        ((9, 80, 40, 20000), 15 + 10 + 7 + 5),
        ((5, 89.99, 25.01, 10000.01), 15 + 10 + 7 + 5),
        ((4, 90, 25, 10000), 12),
        ((0, None, None, None), 12),
    ],
)
def test_risk_score(spark, inputs, score):
    columns = [F.lit(v).cast("double") for v in inputs]
    assert spark.range(1).select(rules.risk_score(*columns)).first()[0] == score


def test_risk_band(spark):
    assert results(spark, rules.risk_band, [105, 85, 84, 60, 59, 35, 34], "int") == [
        "Critical Risk",
        "Critical Risk",
        "High Risk",
        "High Risk",
        "Medium Risk",
        "Medium Risk",
        "Low Risk",
    ]


def test_actions(spark):
    def employee(years, salary, average, quality):
        values = [F.lit(v) for v in (years, salary, average, quality)]
        return spark.range(1).select(rules.employee_action(*values)).first()[0]

    assert employee(10, 100, 100, "Severe Data Issues") == "Retain-HighPriority"
    assert employee(1, 99, 100, "Clean Feed") == "Develop-NewTalent"
    assert employee(5, 99, 100, "Moderate Data Issues") == "Investigate-DataQuality"
    assert employee(5, 99, 100, "Minor Data Issues") == "Monitor-Regular"

    def department(reject_rank, activity_rank, early):
        values = [F.lit(v) for v in (reject_rank, activity_rank, early)]
        return spark.range(1).select(rules.department_action(*values)).first()[0]

    assert department(3, 1, 99) == "Audit ETL Mapping + Source Data Contracts"
    assert department(4, 3, 99) == "Workforce Stabilization Plan"
    assert department(4, 4, 50.01) == "Strengthen Onboarding and Mentoring"
    assert department(4, 4, 50) == "Maintain Current Governance"


def test_salary_position(spark):
    def label(rank, tile):
        return spark.range(1).select(rules.salary_position(F.lit(rank), F.lit(tile))).first()[0]

    assert label(1, 1) == "Top Earner in Department"
    assert label(2, 4) == "Upper Salary Quartile"
    assert label(2, 1) == "Lower Salary Quartile"
    assert label(2, 2) == "Mid Salary Band"
