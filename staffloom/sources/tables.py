"""Reading and writing contract tables as Parquet."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from staffloom.sources.schemas import Contract


def read_table(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """The table at `path`, or the contract's empty table when nothing is there.

    Columns the contract declares as text are read as text: a folder name such as
    `run_id=007` would otherwise be taken for a number.
    """
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return contract.empty(spark)
        raise
    text = {f.name for f in contract.schema.fields if f.dataType == T.StringType()}
    wanted = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in text else f for f in found.schema]
    )
    return found if wanted == found.schema else spark.read.schema(wanted).parquet(path)


def literal_rows(
    spark: SparkSession, contract: Contract, rows: Iterable[dict], now: Column | None = None
) -> DataFrame:
    """Hand-written rows as a DataFrame; columns no row names take their defaults."""
    rows = list(rows)
    named = [f for f in contract.schema.fields if any(f.name in r for r in rows)]
    schema = type(contract.schema)(named)
    data = [tuple(r.get(f.name) for f in named) for r in rows]
    return contract.conform(spark.createDataFrame(data, schema), now)


def append_rows(table: DataFrame, rows: DataFrame, contract: Contract, now: Column | None = None):
    """`table` followed by `rows`, matched by column name, absent columns defaulted."""
    return contract.conform(table, now).unionByName(contract.conform(rows, now))


def write_snapshot(df: DataFrame, path: str, replace: bool = False) -> None:
    """Write the next state of a table to a path of its own.

    The previous state may be an input of `df`, so an existing path is refused unless
    the caller knows it for the rest of a broken attempt.
    """
    df.write.mode("overwrite" if replace else "error").parquet(path)


def append_to(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


# Characters that a partition folder's name holds as %XX.
_ESCAPED = frozenset('"#%\'*/:=?\\{[]^\x7f') | {chr(i) for i in range(1, 32)}


def replace_part(df: DataFrame, path: str, by: str, value: str) -> None:
    """Write the rows of one `value` to a log table kept in one folder per value of `by`.

    That folder is replaced, also by no rows at all; the others are left alone, so
    writing the same rows again does not double them.
    """
    folder = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)
    df.drop(by).write.mode("overwrite").parquet(f"{path}/{by}={folder}")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Give a DataFrame a name for SQL."""
    df.createOrReplaceTempView(name)
    return df
