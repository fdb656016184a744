"""Shared helpers: running sums without one task for all, the shared folder, bounded samples."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tessera.llm import common


def test_prefix_sums(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(k, i, rnd.randint(0, 9)) for k in ("a", None, "b") for i in rnd.sample(range(100_000), 60)]
    df = spark.createDataFrame(rows, "k string, i long, v long")
    for run in (4096, 7):
        monkeypatch.setattr(common, "RUN", run)
        for by in ((), ("k",)):
            some = df.where("k = 'a'") if not by else df
            for r in common.prefix_sums(some, "v", "before", "i", *by).collect():
                assert r.before == sum(v for k, i, v in rows if i < r.i and k == r.k)
    assert common.prefix_sums(df.limit(0), "v", "before", "i", "k").count() == 0


def test_a_cluster_without_shared_folder_is_an_error():
    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {}, sparkContext=context)

    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.checkpoint_dir(session(master))
        assert common.checkpoint_dir(session(master, "hdfs:///x")) == "hdfs:///x"
    assert common.checkpoint_dir(session("local[2]")).startswith("file://")


def test_hash_sample_is_bounded_and_stable(spark):
    rows = spark.range(5000).withColumn("x", F.col("id") * 3)
    some = common.hash_sample(rows, 100, "x").collect()
    assert len(some) == 100 and some == common.hash_sample(rows.repartition(9), 100, "x").collect()
    assert common.hash_sample(rows.limit(30), 100, "x").count() == 30
