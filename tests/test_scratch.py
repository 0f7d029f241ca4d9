"""Where tables between the steps of a job go."""

from types import SimpleNamespace

import pytest

from bindery import scratch


def session(master, **settings):
    context = SimpleNamespace(master=master, applicationId="app-7")
    conf = SimpleNamespace(get=lambda name, other=None: settings.get(name, other))
    return SimpleNamespace(conf=conf, sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(session(master))
    shared = {scratch.SETTING: "hdfs://host/shared/"}
    assert scratch.scratch_root(session(master, **shared)) == "hdfs://host/shared"


@pytest.mark.parametrize("master", ["local", "local[*]", "local[4,2]"])
def test_local_mode_gets_one_folder(master):
    root = scratch.scratch_root(session(master))
    assert root.startswith("file:///") and root == scratch.scratch_root(session(master))
