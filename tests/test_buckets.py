"""Tables in hash buckets: what an upsert reads, replaces and leaves alone."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from staffloom.functions.dates import now
from staffloom.operators.changes import upsert
from staffloom.sources import buckets

SCHEMA = "id long, name string, n int, updated_at timestamp_ntz"


def files(path):
    return {
        os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


@pytest.mark.parametrize("small", [True, False])
def test_untouched_buckets_keep_their_files(spark, ws, tmp_path, request, small):
    if not small:
        request.getfixturevalue("no_broadcast")
    rng = random.Random(4)
    table = spark.createDataFrame([(i, f"n{i}", i % 7, None) for i in range(3_000)] + [(None, "none", 1, None)], SCHEMA)
    path = f"{tmp_path}/table"
    buckets.write_buckets(table, path, "id", 32)
    before = files(path)
    assert len({os.path.dirname(f) for f in before}) == 32
    batch = [(i, f"new{i}", None) for i in [*rng.sample(range(3_000), 4), 9_000]]
    incoming = spark.createDataFrame(batch, "id int, name string, n int")
    how = {"update": ["name"], "stamp": "updated_at", "now": now("2024-01-31 00:00:00")}
    want = rows_of(upsert(table, incoming, "id", **how))
    touched = buckets.upsert_buckets(incoming, path, "id", 32, ws, **how)
    assert 1 <= len(touched) <= 5
    after = files(path)
    kept = {f for f in before if int(os.path.dirname(f).rsplit("=")[-1]) not in touched}
    assert kept and all(after[f] == before[f] for f in kept)
    assert {int(os.path.dirname(f).rsplit("=")[-1]) for f in after if f not in kept} == set(touched)
    assert not {f for f in before if f not in kept} & set(after)
    assert rows_of(buckets.read_buckets(spark, path)) == want
    # Applied again, as after a lost driver, it changes nothing.
    buckets.upsert_buckets(incoming, path, "id", 32, ws, **how)
    stamped = buckets.read_buckets(spark, path).filter("updated_at IS NOT NULL").count()
    assert rows_of(buckets.read_buckets(spark, path).drop("updated_at")) == rows_of(
        upsert(table, incoming, "id", update=["name"]).drop("updated_at")
    ) and stamped == 5


def test_an_empty_batch_touches_nothing(spark, ws, tmp_path):
    table = spark.range(50).withColumn("name", F.lit("x"))
    path = f"{tmp_path}/table"
    buckets.write_buckets(table, path, "id", 4)
    before = files(path)
    assert buckets.upsert_buckets(table.filter("id < 0"), path, "id", 4, ws) == []
    assert files(path) == before
    with pytest.raises(Exception, match="already exists"):
        buckets.write_buckets(table, path, "id", 4)


def test_the_scan_is_pruned_to_the_buckets(spark, tmp_path):
    path = f"{tmp_path}/table"
    buckets.write_buckets(spark.range(500), path, "id", 8)
    some = spark.read.parquet(path).filter(F.col(buckets.BUCKET).isin([1, 2]))
    assert "PartitionFilters: [isnotnull(bucket" in some._jdf.queryExecution().toString() or (
        "PartitionFilters: [bucket" in some._jdf.queryExecution().toString()
    )
