"""Shared scratch: taken from the session, a temporary folder only locally."""

import pytest

from ordermill import session


class FakeContext:
    def __init__(self, master, configured=None):
        self.master, self.dir, self.configured = master, None, configured

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path

    def getConf(self):
        return {"spark.checkpoint.dir": self.configured} if self.configured else {}


class FakeSession:
    def __init__(self, *args):
        self.sparkContext, self.conf = FakeContext(*args), {}


def test_a_configured_folder_is_used_anywhere():
    for master in ("local[2]", "yarn", "local-cluster[2,1,512]"):
        assert session.checkpoint_root(FakeSession(master, "hdfs:///shared")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,512]"])
def test_a_cluster_without_one_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(FakeSession(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_session_gets_a_temporary_one(master):
    assert "ordermill-ckpt-" in session.checkpoint_root(FakeSession(master))


def test_factory_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.ui.enabled") == "false"
