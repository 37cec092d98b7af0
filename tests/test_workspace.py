"""Which folder intermediate tables go to."""

from types import SimpleNamespace

import pytest

from tidefeed.workspace import new_folder, shared_folder


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder, self.applicationId = master, folder, f"app-{id(self)}"

    def getCheckpointDir(self):
        return self.folder


def session(master, configured=None, folder=None):
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master, folder))


def test_the_configured_folder_comes_first():
    assert shared_folder(session("yarn", "hdfs://x/cp", "hdfs://x/other")) == "hdfs://x/cp"
    assert shared_folder(session("yarn", None, "hdfs://x/other")) == "hdfs://x/other"


def test_a_cluster_without_one_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://x:7077"))


def test_local_mode_makes_one_and_keeps_it():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)
    assert local.sparkContext.folder is None


def test_folders_are_new_each_time(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(shared_folder(spark) + "/tidefeed/x-")
