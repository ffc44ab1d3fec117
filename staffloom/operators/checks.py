"""Quality checks that return what breaks a table's promises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffloom.sources.schemas import Contract


def repeated_keys(df: DataFrame, key: Sequence[str], allow_null: bool = False) -> DataFrame:
    """Key values held by more than one row. NULLs are exempt when allowed (UNIQUE)."""
    if allow_null:
        df = df.dropna(subset=list(key))
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def _per_column(df: DataFrame, tests: Mapping[str, Column], counted: str) -> DataFrame:
    """One row per column: how many rows its test holds for, in one pass."""
    if not tests:
        raise ValueError("no column to check")
    sums = df.agg(*[F.coalesce(F.count_if(t), F.lit(0)).alias(c) for c, t in tests.items()])
    return sums.unpivot([], list(tests), "column_name", counted)


def missing_values(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return _per_column(df, {c: F.col(c).isNull() for c in required}, "null_rows")


def overlong_values(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    return _per_column(
        df, {c: F.length(c) > n for c, n in lengths.items()}, "overlong_rows"
    )


def unfit_numbers(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Values that do not fit the declared decimal type."""
    return _per_column(
        df,
        {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()},
        "unfit_rows",
    )


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values without a parent and how many rows hold each.

    Rows are counted per key first, so the join sees each key once.
    """
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counted.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """What a table breaks of its contract: check_name, column_name, bad_rows.

    Required columns, lengths and decimal types are counted in one pass over the
    rows; for keys and unique columns the repeated values are counted.
    """
    tests = {f"required {c}": F.col(c).isNull() for c in contract.required}
    tests |= {f"length {c}": F.length(c) > n for c, n in contract.lengths.items()}
    tests |= {
        f"type {f.name}": F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in contract.schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    report = _per_column(df, tests, "bad_rows")
    repeats = [("key", contract.key, False), *[("unique", (c,), True) for c in contract.unique]]
    for check, columns, allow_null in repeats:
        if columns:
            label = F.lit(f"{check} {','.join(columns)}").alias("column_name")
            repeated = repeated_keys(df, columns, allow_null)
            counted = repeated.agg(F.count(F.lit(1)).alias("bad_rows"))
            report = report.unionByName(counted.select(label, "bad_rows"))
    name = F.split("column_name", " ")
    return report.select(
        name[0].alias("check_name"), name[1].alias("column_name"), "bad_rows"
    )
