"""Session helpers: cluster sizing and the checkpoint folder."""

from types import SimpleNamespace

import pytest

from gaugekeep.session import cluster_conf, ensure_checkpoint_dir, scratch_dir


def test_cluster_conf_scales_with_input():
    small, big = cluster_conf(10 ** 9), cluster_conf(100 * 2 ** 40)
    assert small["spark.sql.shuffle.partitions"] == "200"            # floor; AQE coalesces
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2 ** 40 // (256 << 20))  # no cap
    assert cluster_conf(2 ** 40)["spark.sql.shuffle.partitions"] == str(2 ** 40 // (256 << 20))
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(big["spark.sql.adaptive.autoBroadcastJoinThreshold"]) == 64 << 20


def test_checkpoint_dir_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    s1, s2 = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert s1 != s2 and s1.startswith(d.rstrip("/"))


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn"])
def test_several_processes_need_a_shared_folder(master):
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(spark)
