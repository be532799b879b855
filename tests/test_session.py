"""Checkpoint-root rules: read from the session; own folder only for local mode."""

import os

import pytest

from meterlens.session import ensure_checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class _Session:
    def __init__(self, conf, context):
        self.conf, self._context = _Conf(conf), context

    @property
    def sparkContext(self):
        if self._context is None:
            raise RuntimeError("no context on a Connect client")
        return self._context


def test_configured_root_is_used():
    s = _Session({"spark.checkpoint.dir": "hdfs://shared/ck"}, _Context("yarn"))
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ck"
    assert scratch_path(s, "stage").startswith("hdfs://shared/ck/stage-")


def test_cluster_without_root_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session({}, _Context("yarn")))


def test_local_without_root_gets_own_folder():
    assert "meterlens-checkpoints" in ensure_checkpoint_dir(_Session({}, _Context("local[4]")))


def test_connect_client_reads_conf():
    s = _Session({"spark.checkpoint.dir": "s3a://b/ck", "spark.master": "sc://x"}, None)
    assert ensure_checkpoint_dir(s) == "s3a://b/ck"


def test_real_session_has_a_root(spark):
    assert ensure_checkpoint_dir(spark)


def test_session_leaves_the_shuffle_width_to_the_caller():
    import inspect

    from meterlens.session import build_session

    defaults = inspect.signature(build_session).parameters
    assert defaults["shuffle_partitions"].default is None
    assert defaults["initial_partitions"].default is None


def test_remove_path_deletes_a_folder(spark, scratch):
    from meterlens.session import remove_path

    spark.range(3).write.parquet(f"{scratch}/gone")
    remove_path(spark, f"{scratch}/gone")
    assert not os.path.exists(f"{scratch}/gone")
