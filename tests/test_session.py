from types import SimpleNamespace

import pytest

from crossfade.session import shared_dir


def fake(master, configured=None, given=None):
    context = SimpleNamespace(master=master, folder=given)
    context.getCheckpointDir = lambda: context.folder
    context.setCheckpointDir = lambda folder: setattr(context, "folder", folder)
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_setting_comes_first():
    spark = fake("spark://x", "s3a://b/cp/", None)
    assert shared_dir(spark) == "s3a://b/cp"
    assert spark.sparkContext.folder == "s3a://b/cp/"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake("spark://x"))
    assert shared_dir(fake("spark://x", None, "hdfs:/cp/1")) == "hdfs:/cp/1"


def test_local_master_gets_one_folder():
    spark = fake("local[2]")
    assert shared_dir(spark) == shared_dir(spark)
