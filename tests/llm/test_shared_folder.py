from types import SimpleNamespace

import pytest

from tallycheck.llm.common import shared_dir


def session(master, folder=None):
    context = SimpleNamespace(master=master, getConf=lambda: {"spark.checkpoint.dir": folder}, getCheckpointDir=lambda: folder)
    return SimpleNamespace(sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("spark://host:7077", "hdfs://shared/x")) == "hdfs://shared/x"
