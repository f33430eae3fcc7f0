"""Intermediate tables live in the shared folder and can be removed together."""

import pytest

from candlewick import session


def test_stage_uses_the_named_folder(spark):
    df = session.stage(spark.range(10), "ten")
    assert df.count() == 10
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert all(root.split(":")[-1].strip("/") in f for f in df.inputFiles())


def test_named_folder_is_kept(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert session.scratch_path(spark, "x").startswith(session.scratch_root(spark))
    if before:
        assert spark.conf.get("spark.checkpoint.dir") == before and session.scratch_root(spark) == before.rstrip("/")


class Cluster:
    """A session of a cluster, as far as the shared folder is concerned."""

    def __init__(self, folder=None, master="spark://host:7077"):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda _: None})()


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://x"])
def test_no_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster(master=master))
    assert session.scratch_root(Cluster("hdfs://shared/scratch/", master)) == "hdfs://shared/scratch"


def test_scratch_is_one_folder(spark):
    df = session.stage(spark.range(3), "gone")
    path = spark._jvm.org.apache.hadoop.fs.Path(session.scratch_folder(spark))
    assert df.count() == 3 and path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
