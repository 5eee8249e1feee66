"""The checkpoint root: the cluster's setting, or a folder of our own on one machine."""

import os
from types import SimpleNamespace

import pytest

from flight_engine.session import checkpoint_root


def session(master, setting=None, app="app-1"):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: setting or d),
                           sparkContext=SimpleNamespace(applicationId=app, master=master))


def test_the_clusters_folder_is_used():
    assert checkpoint_root(session("spark://h:1", "hdfs://x/ck/")) == "hdfs://x/ck"


def test_a_local_session_without_the_setting_gets_one_folder():
    a = checkpoint_root(session("local[4]"))
    assert os.path.isdir(a) and checkpoint_root(session("local[4]")) == a
    assert checkpoint_root(session("local[4]", app="app-2")) != a


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_root(session("yarn", app="app-3"))


def test_files_round_trip(spark):
    from flight_engine import files
    from flight_engine.session import scratch_path
    path = scratch_path(spark, "t-files")
    files.write_text(spark, f"{path}/a/b.txt", "é")
    assert files.read_text(spark, f"{path}/a/b.txt") == "é" and files.folders(spark, path) == ["a"]
    assert files.delete(spark, path) and not files.exists(spark, path)
    assert files.read_text(spark, f"{path}/a/b.txt") is None and files.folders(spark, path) == []
