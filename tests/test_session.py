from __future__ import annotations

from types import SimpleNamespace

import pytest

from aislewise.session import scratch_path, shared_dir


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, setting=None):
    conf = SimpleNamespace(get=lambda key, default=None: setting or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_setting_wins():
    assert shared_dir(session("yarn", "hdfs:///shared/x/")) == "hdfs:///shared/x"
    assert scratch_path(session("yarn", "hdfs:///shared"), "t").startswith("hdfs:///shared/t-")


def test_cluster_without_setting_is_refused():
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077"))


def test_local_session_gets_one_folder():
    local = session("local[4]")
    assert shared_dir(local) == shared_dir(local) != ""


def test_real_session_reads_its_setting(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
