"""Tables kept in hash buckets of their key, so that a small batch rewrites few files.

A bucket is a folder `bucket=N`. An upsert reads and replaces only the buckets its keys fall
in; the files of the others are not touched. Replacing is by dynamic partition overwrite: a
task that is lost is run again, and a batch whose driver was lost half way is applied again
with the same outcome, since every key it names then takes the same values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffloom.operators.changes import align, upsert
from staffloom.sources.workspace import Workspace

BUCKET = "bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key: the same for whole numbers of any width."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write `df`, which has each key once, as a table of `buckets` buckets of its own path."""
    _replace(df, path, key, buckets, "error")


def _replace(df: DataFrame, path: str, key: str, buckets: int, mode: str) -> None:
    placed = df.withColumn(BUCKET, bucket_of(F.col(key), buckets))
    writer = placed.repartition(BUCKET).write.partitionBy(BUCKET).mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert_buckets(
    incoming: DataFrame,
    path: str,
    key: str,
    buckets: int,
    ws: Workspace,
    update: Sequence[str] | None = None,
    stamp: str | None = None,
    now: Column | None = None,
) -> list[int]:
    """Upsert `incoming`, see `changes.upsert`, into the table at `path`; which buckets were
    replaced. `buckets` is the number the table was written with."""
    table = ws.spark.read.parquet(path)
    incoming = ws.settle(incoming, "incoming")
    # At most `buckets` numbers.
    hit = incoming.select(bucket_of(F.col(key), buckets).alias(BUCKET)).distinct()
    touched = sorted(hit.agg(F.collect_list(BUCKET)).first()[0])
    if not touched:
        return []
    old = table.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    # The files read are the files replaced, so the outcome is settled in between.
    after = ws.settle(upsert(old, incoming, key, update, stamp, now), "after")
    columns = [c for c in table.columns if c != BUCKET]
    if stamp and stamp not in columns:
        raise ValueError(f"the table has no column {stamp}")
    _replace(align(after, table.select(*columns)), path, key, buckets, "overwrite")
    return touched
