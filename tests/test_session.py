from types import SimpleNamespace

import pytest

from hourlake.session import shared_root


def _session(master, root=None):
    conf = SimpleNamespace(get=lambda key, default=None: root if key == "spark.checkpoint.dir" else default)
    sc = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=conf, sparkContext=sc)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://host"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_session(master))
    assert shared_root(_session(master, "hdfs://nn/shared/")) == "hdfs://nn/shared"
