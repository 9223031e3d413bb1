"""Shared checkpoint folder: taken from the session, never a local folder
on a cluster."""

import pytest

from tillflow.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self._dir = None

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})


def test_configured_folder_is_used():
    s = _Session("spark://head:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_cluster_without_setting_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("yarn"))


def test_local_master_gets_a_folder_for_tests():
    s = _Session("local[2]")
    assert checkpoint_dir(s)


def test_real_session_has_a_folder(spark):
    assert spark.sparkContext.getCheckpointDir()


def test_stream_batches_are_bounded_by_events(spark, monkeypatch):
    from tillflow.plans import registry
    feed = spark.range(1000)
    assert registry._stream_files(feed) == registry.STREAM_LEAST_FILES
    monkeypatch.setattr(registry, "STREAM_FILE_EVENTS", 10)
    assert registry._stream_files(feed) == 100  # more events, more files and batches
