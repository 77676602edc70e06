import glob
from types import SimpleNamespace

import pytest

from vanewatch.scratch import settle, settled, shared_dir


def session(master, setting=None, current=None):
    """What ``shared_dir`` asks a session for; ``used`` collects the folders it sets."""
    used = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: (used or [current])[-1], setCheckpointDir=used.append
    )
    conf = SimpleNamespace(get=lambda key, default: setting)
    return SimpleNamespace(sparkContext=context, conf=conf, used=used)


def test_the_named_folder_is_used():
    cluster = session("yarn", "hdfs:///shared")
    assert shared_dir(cluster) == "hdfs:///shared" and cluster.used == ["hdfs:///shared"]
    cluster = session("yarn", "hdfs:///shared", current="hdfs:///shared/1")
    assert shared_dir(cluster) == "hdfs:///shared" and cluster.used == []
    assert shared_dir(session("yarn", current="hdfs:///other")) == "hdfs:///other"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_a_local_session_gets_one_folder():
    local = session("local[4]")
    assert shared_dir(local) == shared_dir(local) and len(local.used) == 1


def test_settled_rows_do_not_depend_on_their_source(spark, folder):
    spark.range(5).write.parquet(folder + "/a")
    settled = settle(spark.read.parquet(folder + "/a"))
    assert "FileScan" not in settled._jdf.queryExecution().executedPlan().toString()
    spark.range(9).write.mode("overwrite").parquet(folder + "/a")
    assert settled.count() == 5


def test_settled_rows_are_removed_in_the_end(spark):
    pattern = f"{shared_dir(spark).removeprefix('file:').replace('//', '/')}/settled-*"
    before = set(glob.glob(pattern))
    with pytest.raises(KeyError):
        with settled(spark.range(5)) as rows:
            assert rows.count() == 5 and len(set(glob.glob(pattern)) - before) == 1
            raise KeyError
    assert set(glob.glob(pattern)) == before
