"""Checkpoint-folder resolution (no Spark needed: a stub context)."""

import pytest

from turnout.session import ensure_checkpoint_dir


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)


class _SC:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Spark:
    def __init__(self, master, conf=None):
        self.sparkContext = _SC(master, conf or {})

        class _C:
            def get(self, k, default=None):
                return default
        self.conf = _C()


def test_configured_folder_is_used():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_master_gets_a_temporary_folder():
    s = _Spark("local[4]")
    d = ensure_checkpoint_dir(s)
    assert d and "turnout-ckpt-" in d


def test_cluster_without_folder_fails_clearly():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Spark("k8s://https://api"))


def test_cleanup_removes_scratch_folders(spark):
    import os
    from turnout.session import cleanup, scratch_path
    path = scratch_path(spark, "t-clean")
    spark.range(3).write.parquet(path)
    plain = path.removeprefix("file:")
    assert os.path.isdir(plain) and cleanup(spark) >= 1 and not os.path.exists(plain)
    assert cleanup(spark) == 0
