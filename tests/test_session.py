"""Where scratch data goes and how a session is sized."""

from types import SimpleNamespace

import pytest

from accesslens.session import (
    broadcast_if_small,
    scan_bytes,
    scratch_path,
    shared_folder,
    shuffle_partitions,
    stage,
)

TB = 2**40


def fake(conf, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key, default)),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_cluster_names_the_folder():
    named = fake({"spark.checkpoint.dir": "hdfs:///shared/"}, "yarn")
    assert shared_folder(named) == "hdfs:///shared"
    assert scratch_path(named, "a") != scratch_path(named, "a")


def test_only_a_local_session_may_choose_one():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake({}, "yarn"))
    local = fake({}, "local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_sizes_follow_the_input():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(TB) == 4096
    assert shuffle_partitions(100 * TB) == 409_600
    assert scan_bytes(TB) == 128 * 2**20
    assert 512 * 2**20 < scan_bytes(100 * TB) < 550 * 2**20


def test_staging_reads_back_only_what_is_asked(spark):
    staged = stage(spark.range(10).selectExpr("id", "id * 2 AS twice"), scratch_path(spark, "staged"))
    scan = staged.select("twice").where("twice > 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:bigint>" in scan and "GreaterThan(twice,3)" in scan
    assert sorted(r["twice"] for r in staged.collect()) == list(range(0, 20, 2))


def test_broadcasts_are_measured_first(spark):
    small = spark.createDataFrame([(1, "12345678"), (2, None)], "n int, text string")
    hinted = broadcast_if_small(small, 72)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert broadcast_if_small(small, 71) is small
    assert broadcast_if_small(small.limit(0), 0) is not small
