"""The shared folder: taken from the session, private only on a local master."""

from types import SimpleNamespace

import pytest

from ledgerline.session import shared_dir


def _session(master, conf=None, checkpoint=None):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint, setCheckpointDir=made.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: (conf or {}).get(k, d))), made


def test_named_folder_is_used():
    spark, made = _session("spark://host:1", {"spark.checkpoint.dir": "hdfs://x/c/"})
    assert shared_dir(spark) == "hdfs://x/c" and made == ["hdfs://x/c/"]


@pytest.mark.parametrize("master", ["spark://host:1", "yarn", "k8s://h", "local-cluster[3,2,1024]"])
def test_cluster_without_a_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session(master)[0])


@pytest.mark.parametrize("master", ["local", "local[*]", "local[4,2]"])
def test_local_master_gets_a_folder(master, tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    spark, made = _session(master)
    assert shared_dir(spark).startswith(str(tmp_path)) and len(made) == 1


def test_context_folder_is_kept():
    spark, made = _session("yarn", checkpoint="hdfs://x/set")
    assert shared_dir(spark) == "hdfs://x/set" and made == []
