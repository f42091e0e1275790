from __future__ import annotations

import pytest

from courierlens import session


def test_shuffle_partitions_are_only_raised(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.size_shuffles(spark, 10, per_partition=100)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        session.size_shuffles(spark, 2550, per_partition=100)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "26"
        session.size_shuffles(spark, 10**14)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "372530"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_named_folder_wins(spark, monkeypatch):
    monkeypatch.setattr(session, "_FOLDERS", {})
    monkeypatch.setattr(session, "_named_folder", lambda spark: "hdfs://shared/folder/")
    application = spark.sparkContext.applicationId
    assert session.shared_folder(spark) == "hdfs://shared/folder"
    assert session.application_folder(spark, "x") == f"hdfs://shared/folder/courierlens/{application}/x"


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(session, "_FOLDERS", {})
    monkeypatch.setattr(session, "is_local", lambda spark: False)
    monkeypatch.setattr(session, "_named_folder", lambda spark: None)
    with pytest.raises(session.NoSharedFolder, match="spark.checkpoint.dir"):
        session.shared_folder(spark)


def test_scan_bytes(spark):
    size = session.scan_bytes(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"))
    assert 30_000 < size < 50_000


def test_a_local_master_falls_back_to_a_temporary_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "_FOLDERS", {})
    monkeypatch.setattr(session, "_named_folder", lambda spark: None)
    folder = session.shared_folder(spark)
    assert folder.startswith("file:///") and session.shared_folder(spark) == folder
    spark.range(3).write.parquet(session.application_folder(spark, "probe"))
    assert spark.read.parquet(session.application_folder(spark, "probe")).count() == 3


def test_the_folder_is_found_once_per_application(spark, monkeypatch):
    before = session.shared_folder(spark)
    monkeypatch.setattr(session, "_named_folder", lambda spark: "file:///elsewhere")
    session.ensure_checkpointing(spark)
    assert session.shared_folder(spark) == before
    assert spark.sparkContext.getCheckpointDir() is not None


def test_nothing_is_left_after_release(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_FOLDERS", {})
    monkeypatch.setattr(session, "_named_folder", lambda spark: f"file://{tmp_path}")
    spark.range(3).write.parquet(session.application_folder(spark, "steps", "x"))
    session.release_application_folder(spark)
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]
