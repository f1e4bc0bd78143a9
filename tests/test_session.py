from types import SimpleNamespace

import pytest

from tenantlens.session import scratch_dir


def session(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    context = SimpleNamespace(master=master, getConf=lambda: conf)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_scratch_lies_in_the_shared_folder():
    spark = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = scratch_dir(spark, "gold"), scratch_dir(spark, "gold")
    assert first.startswith("hdfs:///shared/tenantlens-gold-")
    assert first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "gold")
    assert "tenantlens-gold" in scratch_dir(session("local[2]"), "gold")
