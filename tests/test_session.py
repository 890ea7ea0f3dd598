"""Partition sizing and the checkpoint folder."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from paygrain.session import materialise, sizing, use_checkpoint_dir


def test_partitions_grow_with_the_data():
    small, large = sizing(10 << 30), sizing(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) == 204_800
    assert sizing(100 << 40, scan_bytes=512 << 20)["spark.sql.files.maxPartitionBytes"] == "512m"
    assert int(sizing(1 << 40)["spark.sql.shuffle.partitions"]) == 2048


def fake_session(master: str, configured: str | None, current: str | None = None):
    used = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: used[-1] if used else current, setCheckpointDir=used.append
    )
    conf = SimpleNamespace(get=lambda key, default=None: configured or default)
    return SimpleNamespace(sparkContext=context, conf=conf), used


def test_the_named_folder_is_used():
    session, used = fake_session("yarn", "hdfs:///shared/checkpoints")
    use_checkpoint_dir(session)
    use_checkpoint_dir(session)
    assert used == ["hdfs:///shared/checkpoints"]


def test_a_cluster_without_a_folder_is_refused():
    session, used = fake_session("spark://head:7077", None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        use_checkpoint_dir(session)
    assert used == []


def test_a_folder_set_before_is_kept():
    session, used = fake_session("yarn", None, current="hdfs:///earlier")
    use_checkpoint_dir(session)
    assert used == []


def test_materialised_rows_come_from_files(spark):
    from pyspark.sql import functions as F

    stored = materialise(spark.range(100).withColumn("r", F.rand()))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, stored.collect()))
    assert "Scan ExistingRDD" in stored._jdf.queryExecution().executedPlan().toString()
