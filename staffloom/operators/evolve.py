"""Schema changes as a rewrite of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_column(table: DataFrame, name: str, dtype: str, default: object = None) -> DataFrame:
    """Add a column; existing rows get the default."""
    return table.withColumn(name, F.lit(default).cast(dtype))


def drop_column(table: DataFrame, name: str) -> DataFrame:
    return table.drop(name)


def change_type(table: DataFrame, name: str, dtype: str) -> DataFrame:
    return table.withColumn(name, F.col(name).cast(dtype))
