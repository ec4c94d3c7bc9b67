"""Where intermediate copies may go."""

import os
from types import SimpleNamespace

import pytest

from notemill import session as sessions
from notemill.session import runs_locally, shared_dir


def session(master, named=None):
    known = SimpleNamespace(get=lambda *_: named)
    context = SimpleNamespace(
        master=master, getConf=lambda: SimpleNamespace(get=lambda *_: None), getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None
    )
    return SimpleNamespace(conf=known, sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(master))
    assert shared_dir(session(master, "hdfs://a/b")) == "hdfs://a/b"


def test_one_machine_may_use_a_temporary_folder():
    assert runs_locally("local") and runs_locally("local[8]")
    assert "notemill-" in shared_dir(session("local[2]"))


def test_copies_on_the_way_go_once_the_result_is_written(spark):
    made = []

    def build():
        first = sessions.saved(spark.range(5), "inner")
        made.append(sessions._scratch[-1])
        return first.filter("id > 1")

    rows, path = sessions.saved_alone(spark, build, "outer")
    assert made[0] not in sessions._scratch and sessions._scratch[-1] == path
    assert not os.path.exists(made[0].removeprefix("file:")) and rows.count() == 3
    sessions.drop_scratch(spark, path)
    assert path not in sessions._scratch and not os.path.exists(path.removeprefix("file:"))
