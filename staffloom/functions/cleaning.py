"""Column builders that clean and judge one raw staging record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staffloom import fixedvalues as V


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def read_date(raw: Column) -> Column:
    """Date by the shape of the text; NULL for other shapes and impossible dates."""
    by_shape = [F.when(raw.rlike(shape), F.try_to_date(raw, fmt)) for shape, fmt in V.DATE_SHAPES]
    return F.coalesce(*by_shape)


def read_salary(raw: Column) -> Column:
    """Money after dropping thousands marks and currency signs; NULL when malformed."""
    digits = F.translate(raw, V.SALARY_NOISE, "")
    return F.when(digits.rlike(V.SALARY_SHAPE), digits.try_cast(V.SALARY_TYPE))


def read_department_id(raw: Column) -> Column:
    return F.when(raw.rlike(V.DEPARTMENT_ID_SHAPE), raw.try_cast("bigint"))


def standard_status(raw: Column) -> Column:
    word = F.upper(raw)
    found = [F.when(word.isin(*words), F.lit(label)) for words, label in V.STATUS_WORDS]
    return F.coalesce(*found, F.lit(V.DEFAULT_STATUS))


def business_key(*parts: Column) -> Column:
    return F.concat_ws(V.KEY_SEPARATOR, *[F.coalesce(p, F.lit(V.KEY_MISSING)) for p in parts])


def first_failure(
    first_name: Column, last_name: Column, hire_date: Column, salary: Column, email: Column
) -> Column:
    """The first check a record fails, NULL when it passes them all."""
    checks = (
        (first_name.isNull() | last_name.isNull(), V.REASON_NAMES),
        (hire_date.isNull(), V.REASON_HIRE_DATE),
        (salary.isNull(), V.REASON_SALARY),
        (salary < 0, V.REASON_NEGATIVE),
        (~email.rlike(V.EMAIL_SHAPE), V.REASON_EMAIL),
    )
    return F.coalesce(*[F.when(failed, F.lit(reason)) for failed, reason in checks])


def rejection_reason(failure: Column, is_latest: Column) -> Column:
    return (
        F.when(failure.isNotNull(), failure)
        .when(~is_latest, V.REASON_DUPLICATE)
        .otherwise(V.REASON_UNKNOWN)
    )
