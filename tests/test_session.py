"""Sizing and the folder of durable intermediates."""

import os

import pytest

from headway import session


class Stub:
    """A context and configuration as the session reads them."""

    def __init__(self, master, configured=None, current=None):
        self.master, self.current, self.configured = master, current, configured
        self.sparkContext = self.conf = self

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.configured or default


def test_the_session_names_the_folder():
    assert session.ensure_checkpoint_dir(Stub("yarn", "hdfs:///c")) == "hdfs:///c"
    assert session.ensure_checkpoint_dir(Stub("yarn", "hdfs:///c", "s3a://mine")) == "s3a://mine"


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]"])
def test_no_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Stub(master))


def test_local_folder():
    local = Stub("local[2]")
    assert session.ensure_checkpoint_dir(local) == local.current


def test_sizing():
    small, large = session.sizing(1), session.sizing(100 * 1024 * session.GIB)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert (small[key], large[key]) == ("200", "100000")
    assert (small["spark.sql.files.maxPartitionBytes"], large["spark.sql.files.maxPartitionBytes"]) == ("128m", "1g")


def test_shuffle_tasks(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session.shuffle_tasks(spark) == 8
    spark.conf.set(key, "12")
    try:
        assert session.shuffle_tasks(spark) == 12
    finally:
        spark.conf.unset(key)


def test_session_fits_its_input(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    keys = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes")
    try:
        size = session.fit_session(df, partition_bytes=1000, long_splits_from=1000)
        assert size == os.path.getsize(f"{sf_dir}/events.parquet")
        assert session.shuffle_tasks(spark) == -(-size // 1000)
        assert spark.conf.get(keys[1]) == "1g"
        session.fit_session(df)
        assert session.shuffle_tasks(spark) == 8
    finally:
        for key in keys:
            spark.conf.unset(key)
