"""Business rules as column builders, table-driven from `fixedvalues`."""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from staffloom import fixedvalues as V


# --- helpers ---------------------------------------------------------------


def label_below(value: Column, cuts: Sequence, labels: Sequence[str]) -> Column:
    """The label of the first cut the value is below, else the last (NULL too)."""
    found = [F.when(value < cut, F.lit(label)) for cut, label in zip(cuts, labels)]
    return F.coalesce(*found, F.lit(labels[-1]))


def label_in(value: Column, groups: Sequence[Sequence[str]], labels: Sequence[str]) -> Column:
    """The label of the word list the value is in, NULL when in none."""
    return F.coalesce(*[F.when(value.isin(*g), F.lit(label)) for g, label in zip(groups, labels)])


def label_of(value: Column, labels: Mapping[str, str], other: str) -> Column:
    found = [F.when(value == word, F.lit(label)) for word, label in labels.items()]
    return F.coalesce(*found, F.lit(other))


def points(value: Column, test: Callable, cuts: Sequence[tuple], floor: int) -> Column:
    """Points of the first cut the test holds for, else the floor (NULL too)."""
    earned = [F.when(test(value, cut), F.lit(p)) for cut, p in cuts]
    return F.coalesce(*earned, F.lit(floor))


# --- salary and tenure -------------------------------------------------------


def salary_band(salary: Column) -> Column:
    return label_below(salary, V.SALARY_CUTS, V.SALARY_BANDS)


def compensation_tier(salary: Column) -> Column:
    return label_below(salary, V.SALARY_CUTS, V.COMPENSATION_TIERS)


def tenure_bucket(years: Column) -> Column:
    return label_below(years, V.TENURE_CUTS, V.TENURE_BUCKETS)


def tenure_class(years: Column) -> Column:
    return label_below(years, V.TENURE_CUTS, V.TENURE_CLASSES)


def tenure_stage(years: Column) -> Column:
    return label_below(years, V.TENURE_STAGE_CUTS, V.TENURE_STAGES)


def compensation_index(salary: Column, average: Column) -> Column:
    """Salary over the department average to four places; 0 without a salary."""
    ratio = F.try_divide(salary.cast("decimal(10,2)"), average.cast("decimal(14,6)"))
    return (
        F.when(salary.isNull(), F.lit(0)).otherwise(F.round(ratio, 4)).cast("decimal(12,4)")
    )


def percent_off_average(salary: Column, average: Column) -> Column:
    """How far a salary lies from the average, in percent to two places."""
    average = average.cast("decimal(14,6)")
    share = F.try_divide((salary - average).cast("decimal(16,6)"), average)
    return F.round(share * 100, 2).cast("decimal(20,2)")


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places; NULL for an empty whole."""
    hundredfold = (part.cast("bigint") * 100).cast("decimal(22,0)")
    return F.round(F.try_divide(hundredfold, whole.cast("decimal(20,0)")), 2).cast("decimal(20,2)")


def reject_rate(rejected: Column, source: Column) -> Column:
    rate = percent_of(rejected, source)
    return F.when(source > 0, rate).otherwise(F.lit(0)).cast("decimal(20,2)")


def salary_position(rank: Column, quartile: Column) -> Column:
    return (
        F.when(rank == 1, V.POSITION_TOP)
        .when(quartile == 4, V.POSITION_UPPER)
        .when(quartile == 1, V.POSITION_LOWER)
        .otherwise(V.POSITION_MID)
    )


# --- places and statuses -----------------------------------------------------


def _region(location: Column, labels: Sequence[str], unknown: str, other: str) -> Column:
    known = label_in(F.lower(location), V.REGION_CITIES, labels)
    blank = F.coalesce(F.trim(location), F.lit("")) == ""
    return F.coalesce(known, F.when(blank, F.lit(unknown)), F.lit(other))


def report_region(location: Column) -> Column:
    return _region(location, V.REPORT_REGIONS, V.REPORT_REGION_UNKNOWN, V.REPORT_REGION_OTHER)


def dashboard_region(location: Column) -> Column:
    return _region(
        location, V.DASHBOARD_REGIONS, V.DASHBOARD_REGION_UNKNOWN, V.DASHBOARD_REGION_OTHER
    )


def report_status(status: Column) -> Column:
    return label_of(F.upper(status), V.REPORT_STATUS_LABELS, V.REPORT_STATUS_UNKNOWN)


def dashboard_status(status: Column) -> Column:
    return label_of(F.upper(status), V.DASHBOARD_STATUS_LABELS, V.DASHBOARD_STATUS_UNKNOWN)


# --- quality and actions -----------------------------------------------------


def quality_band(rejects: Column) -> Column:
    return (
        F.when(rejects.isNull(), V.QUALITY_CLEAN)
        .when(rejects.between(1, 2), V.QUALITY_MINOR)
        .when(rejects.between(3, 5), V.QUALITY_MODERATE)
        .otherwise(V.QUALITY_SEVERE)
    )


def employee_action(years: Column, salary: Column, average: Column, quality: Column) -> Column:
    poor = quality.isin(V.QUALITY_MODERATE, V.QUALITY_SEVERE)
    return (
        F.when((years >= V.RETAIN_YEARS) & (salary >= average), V.ACTION_RETAIN)
        .when((years < V.DEVELOP_YEARS) & (salary < average), V.ACTION_DEVELOP)
        .when(poor, V.ACTION_INVESTIGATE)
        .otherwise(V.ACTION_MONITOR)
    )


# --- department risk -----------------------------------------------------------


def risk_score(
    rejects: Column,
    active_pct: Column,
    early_pct: Column,
    deviation: Column,
    *,
    reject_points=V.RISK_REJECTS,
    activity_points=V.RISK_ACTIVITY,
    early_points=V.RISK_EARLY_TENURE,
    spread_points=V.RISK_SALARY_SPREAD,
) -> Column:
    parts = (
        points(rejects, operator.ge, *reject_points),
        points(active_pct, operator.lt, *activity_points),
        points(early_pct, operator.gt, *early_points),
        points(deviation, operator.gt, *spread_points),
    )
    return reduce(operator.add, parts)


def risk_band(score: Column) -> Column:
    found = [F.when(score >= cut, F.lit(band)) for cut, band in V.RISK_BANDS]
    return F.coalesce(*found, F.lit(V.RISK_BAND_LOW))


def department_action(reject_rank: Column, low_activity_rank: Column, early_pct: Column) -> Column:
    return (
        F.when(reject_rank <= V.DEPT_ACTION_RANK, V.DEPT_ACTION_AUDIT)
        .when(low_activity_rank <= V.DEPT_ACTION_RANK, V.DEPT_ACTION_STABILISE)
        .when(early_pct > V.DEPT_ACTION_EARLY_PCT, V.DEPT_ACTION_ONBOARD)
        .otherwise(V.DEPT_ACTION_MAINTAIN)
    )
