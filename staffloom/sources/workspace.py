"""Intermediate tables, written to the shared folder the cluster names.

A settled table cuts lineage: a lost executor costs a re-read, not a recompute,
every reader sees the same rows, and Catalyst knows its real size, so it decides
on broadcasts by measure and not by guess.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`.

    Only a local session without one gets a temporary folder of its own; on a
    cluster a folder on the driver's disk would not be seen by the executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="staffloom-"))
    return context.getCheckpointDir()


class Workspace:
    """A folder of settled tables for one job."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/staffloom/{uuid.uuid4().hex}"

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` once and return a scan of what was written."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def settle_counted(
        self, df: DataFrame, name: str, measure: Column | None = None
    ) -> tuple[DataFrame, int]:
        """`settle`, and how many rows there are, or another aggregate, found while they are
        written."""
        seen = Observation()
        wanted = F.count(F.lit(1)) if measure is None else measure
        settled = self.settle(df.observe(seen, wanted.alias("wanted")), name)
        return settled, seen.get.get("wanted") or 0


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size of `df`: compressed bytes for a scan, a product above joins.

    It says nothing on the number of rows. Like `broadcast_limit` it reads the classic
    session's own objects, so the library does not run over Spark Connect.
    """
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(spark: SparkSession) -> int:
    """`spark.sql.autoBroadcastJoinThreshold` in bytes; -1 when broadcasts are off."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def is_broadcastable(df: DataFrame) -> bool:
    return planned_bytes(df) <= broadcast_limit(df.sparkSession)
