import importlib
import os

import pytest

from revcat.session import clean_scratch, scratch_dir, written

module = importlib.import_module("revcat.session")  # the package also exports a function of that name


class Cluster:
    """Just what scratch_dir asks a session."""

    def __init__(self, setting, master="yarn"):
        self.conf = self.sparkContext = self
        self.setting, self.master = setting, master

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return None


def test_scratch_is_shared_on_a_cluster(monkeypatch):
    monkeypatch.setattr(module, "_scratch", [])
    assert scratch_dir(Cluster("hdfs:///shared/"), "x").startswith("hdfs:///shared/revcat/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster(None), "x")


def test_local_scratch_and_its_removal(spark, monkeypatch):
    monkeypatch.setattr(module, "_scratch", [])
    table = written(spark.range(5), "t")
    (path,) = module._scratch
    assert table.count() == 5 and os.path.exists(path)
    assert clean_scratch(spark) == 1 and not os.path.exists(path)
