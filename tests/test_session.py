import os

import pytest
from pyspark.sql import SparkSession

from tessera import session


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = session.checkpoint_dir(spark)
    a, b = session.scratch_path(spark, "t"), session.scratch_path(spark, "t")
    assert a != b and a.startswith(f"{base}/scratch/")
    session.use_checkpoint_dir(spark, "/not/used")
    assert session.checkpoint_dir(spark) == base


def test_an_unnamed_folder_raises_and_a_named_one_is_taken(spark, monkeypatch, tmp_dir):
    class Context:
        folder = None

        def getCheckpointDir(self):  # noqa: N802
            return self.folder

        def setCheckpointDir(self, folder):  # noqa: N802
            self.folder = folder + "/app"

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(Session, "t")
    Session.conf = {session.CHECKPOINT_CONF: "/shared"}
    assert session.scratch_path(Session, "t").startswith("/shared/app/scratch/")


def test_cut_lineage_and_persist(spark):
    df = spark.range(10).selectExpr("id * 2 AS x")
    assert session.cut_lineage(df).count() == 10
    cached = session.persist_frame(df)
    assert cached.is_cached
    cached.unpersist()


def test_removed_paths_are_gone(spark):
    path = session.scratch_path(spark, "t.parquet")
    spark.range(3).write.parquet(path)
    session.remove_path(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    assert SparkSession.getActiveSession() is not None


def test_cluster_conf():
    conf = session.cluster_conf()
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(conf["spark.sql.shuffle.partitions"]) >= 1000
