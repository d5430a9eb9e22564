"""The checkpoint folder is read from the session; a machine-local temporary
folder is used only for local-mode sessions."""

import pytest

from vaultscope.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None, conf=None):
        self.master = master
        self._dir = current
        self._conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, sc, conf=None):
        self.sparkContext = sc
        self.conf = _Conf(conf or {})


def test_existing_dir_is_kept():
    s = _Session(_Context("yarn", current="hdfs://nn/ckpt/abc"))
    assert checkpoint_dir(s) == "hdfs://nn/ckpt/abc"


def test_session_setting_is_used():
    s = _Session(_Context("yarn"), {"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"


@pytest.mark.parametrize("master", ["k8s://https://api:443", "yarn", "local-cluster[3,2,1024]"])
def test_cluster_without_shared_dir_fails(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session(_Context(master)))


def test_local_mode_gets_private_dir(tmp_path):
    path = checkpoint_dir(_Session(_Context("local[4]")))
    assert "vaultscope-ckpt-" in path
