"""Where settled tables go."""

from __future__ import annotations

import types

import pytest

from staffloom.sources.workspace import Workspace, shared_folder


def session(folder=None, own=None, master="spark://cluster:7077"):
    state = {"own": own}
    context = types.SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["own"],
        setCheckpointDir=lambda path: state.update(own=path),
    )
    conf = types.SimpleNamespace(get=lambda key, default=None: folder or default)
    return types.SimpleNamespace(conf=conf, sparkContext=context)


def test_the_session_names_the_folder():
    assert shared_folder(session("hdfs:///shared")) == "hdfs:///shared"
    assert Workspace(session("hdfs:///shared/")).root.startswith("hdfs:///shared/staffloom/")
    assert shared_folder(session(own="hdfs:///set-before")) == "hdfs:///set-before"


def test_a_cluster_must_name_one():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session())


def test_a_local_session_makes_one_of_its_own():
    local = session(master="local[2]")
    assert shared_folder(local) == shared_folder(local)
    assert "staffloom-" in shared_folder(local)


def test_settled_files_are_packed_tightly(spark, ws):
    settled = ws.settle(spark.range(10), "ten")
    assert all(".zstd." in f for f in settled.inputFiles())
