"""Checkpoint folder rules."""

import os
from types import SimpleNamespace

import pytest

from insight.session import ensure_checkpoint_dir
from insight.sources.checkpoint import materialize, release


def fake(master, configured=None):
    made = []
    context = SimpleNamespace(getCheckpointDir=lambda: None, master=master, setCheckpointDir=made.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured)), made


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake(master)[0])
    session, made = fake(master, "hdfs://x/ckpt")
    assert ensure_checkpoint_dir(session) == "hdfs://x/ckpt" and made == ["hdfs://x/ckpt"]


def test_a_local_session_gets_a_scratch_folder():
    session, made = fake("local[4]")
    assert os.path.isdir(ensure_checkpoint_dir(session)) and len(made) == 1


def test_release_removes_the_tables(spark):
    df = materialize(spark.range(5).toDF("i"), "probe")
    path = df.inputFiles()[0].removeprefix("file://")
    assert df.count() == 5 and os.path.exists(path)
    release(spark)
    assert not os.path.exists(path)
