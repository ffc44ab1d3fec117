from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staffloom.session import local_session  # noqa: E402
from staffloom.sources.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session("staffloom-tests", "8", **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture
def ws(spark):
    return Workspace(spark)


@pytest.fixture
def no_broadcast(spark):
    """Make every table count as too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_of(df) -> list[tuple]:
    """Rows as sorted tuples in column name order."""
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
