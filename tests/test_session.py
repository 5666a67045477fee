from __future__ import annotations

from types import SimpleNamespace

import pytest

from tripflow.session import scratch_path, stage


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_scratch_paths_lie_in_the_shared_folder_and_are_new():
    shared = session("spark://host:7077", "hdfs://lake/checkpoints/")
    first, second = scratch_path(shared, "x"), scratch_path(shared, "x")
    assert first.startswith("hdfs://lake/checkpoints/tripflow/x-") and first != second


def test_only_a_local_master_may_use_a_temporary_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session("yarn"), "x")
    local = session("local[2]")
    folder = scratch_path(local, "x").rpartition("/tripflow/")[0]
    assert folder == local.sparkContext.folder


def test_staged_rows_come_from_files(spark):
    rows = stage(spark.range(10), "numbers")
    assert len(rows.inputFiles()) > 0
    assert sorted(row["id"] for row in rows.collect()) == list(range(10))
