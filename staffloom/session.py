"""A local session for tests and the bench. A cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "staffloom", cores: str = "8", **conf: str) -> SparkSession:
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": os.environ.get("STAFFLOOM_DRIVER_MEMORY", "8g"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
