from types import SimpleNamespace

import pytest

from arrears import session


def fake(master, setting=None, warehouse="file:/home/me/spark-warehouse"):
    calls = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=calls.append)
    settings = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": warehouse}
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key) or default)
    return SimpleNamespace(sparkContext=context, conf=conf), calls


def test_work_dir_is_the_shared_folder_of_the_session():
    spark, calls = fake("yarn", "hdfs:///shared")
    assert session.work_dir(spark) == "hdfs:///shared"
    assert calls == ["hdfs:///shared/checkpoints"]


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        session.work_dir(fake(master)[0])


def test_a_shared_warehouse_stands_in():
    assert session.work_dir(fake("yarn", warehouse="hdfs:///wh/")[0]) == "hdfs:///wh/arrears-work"
    assert session.work_dir(fake("local[2]")[0]) == "file:/home/me/spark-warehouse/arrears-work"


def test_the_checkpoint_folder_of_the_session_is_kept(spark):
    root = session.work_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root
    assert root in spark.sparkContext.getCheckpointDir()
