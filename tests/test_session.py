"""Checkpoint-folder resolution (no machine-local fallback on a cluster)."""

import pytest

from supplyscope.session import ensure_checkpoint_dir, recommended_cluster_conf


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf, self.sparkContext = _Conf(conf or {}), _Ctx(master, ckpt)


def test_configured_dir_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ck"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ck"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ck"


def test_cluster_without_dir_fails_loudly():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://master:7077"))


def test_local_without_dir_gets_a_private_folder():
    s = _Session("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d and s.sparkContext.getCheckpointDir() == d


def test_recommended_conf_scales_partitions():
    c = recommended_cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) >= 100 * 1024 ** 4 // (256 * 1024 ** 2)
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
