import pytest

from factloom import session


class Context:
    def __init__(self, master, checkpoint=None):
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class Session:
    def __init__(self, master, conf=None, checkpoint=None):
        self.sparkContext, self.conf = Context(master, checkpoint), conf or {}


def test_the_setting_of_the_cluster_is_used():
    named = Session("yarn", {session.CHECKPOINT_CONF: "hdfs:///shared/"})
    assert session.shared_root(named) == "hdfs:///shared"
    assert session.shared_root(Session("yarn", checkpoint="hdfs:///c")) == "hdfs:///c"


def test_only_a_local_master_may_fall_back():
    with pytest.raises(RuntimeError, match=session.CHECKPOINT_CONF):
        session.shared_root(Session("yarn"))
    local = Session("local[2]")
    assert session.shared_root(local) == session.shared_root(local)


def test_each_run_has_a_path_of_its_own(spark):
    assert session.shared_path(spark, "x") != session.shared_path(spark, "x")
    df = spark.range(3)
    assert session.stored(spark, df, "ids").exceptAll(df).count() == 0
