"""Shared work folder: read from the session, never machine-local on a cluster."""

import pytest

from linedocs.session import work_dir


class _Conf:
    def __init__(self, v):
        self.v = v
        self.set_calls = []

    def get(self, key, default=None):
        return self.v if key == "spark.checkpoint.dir" else default

    def set(self, k, v):
        self.set_calls.append((k, v))


class _SC:
    def __init__(self, master, ckpt=None):
        self.master = master
        self.ckpt = ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Spark:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf = _Conf(conf)
        self.sparkContext = _SC(master, ckpt)


def test_uses_the_cluster_setting():
    d = work_dir(_Spark("yarn", conf="hdfs:///shared/ckpt"), "x")
    assert d.startswith("hdfs:///shared/ckpt/x-")


def test_falls_back_to_the_context_checkpoint_dir():
    assert work_dir(_Spark("yarn", ckpt="s3a://b/ck"), "t").startswith("s3a://b/ck/t-")


def test_cluster_without_setting_refuses_local_folders():
    with pytest.raises(RuntimeError):
        work_dir(_Spark("spark://host:7077"))


def test_local_session_without_setting_gets_scratch_folder():
    s = _Spark("local[2]")
    d = work_dir(s, "y")
    assert s.sparkContext.ckpt and d.startswith(s.sparkContext.ckpt)
    assert d != work_dir(s, "y")  # a fresh folder per call
