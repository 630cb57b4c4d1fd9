"""Upkeep of stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import live_queries as L, messages as M
from catalog.derived import Tables
from headway.operators.retention import after_cleanup
from headway.plans.feed_load import load_messages
from headway.plans.upkeep import after_import, clean_realtime, purge_realtime, remove_source
from headway.schemas import REALTIME_TABLES, STATIC_TABLES
from headway.sources import sinks
from catalog.static_queries import typed

SF = "/root/testdata/sf0.001"
NOW = "2024-01-22 00:00:00"


def two_batches(spark, root):
    t = Tables(spark, SF)
    messages = M.feed_messages(t).where("error is null and message is not null")
    half = F.col("received_at") < "2024-01-16"
    for number, part in enumerate((messages.where(half), messages.where(~half))):
        load_messages(part, L.endpoints(t), t["versions"], root, number)
    return t, messages


def plain_rows(tables):
    return {n: sorted(map(str, df.select(*sorted(set(df.columns) - {"batch_id"})).collect()))
            for n, df in tables.items()}


def all_rows(spark, root):
    return plain_rows({n: spark.read.parquet(f"{root}/{n}") for n in REALTIME_TABLES})


def test_cleanup_removes_in_place(spark, tmp_path):
    root = str(tmp_path)
    two_batches(spark, root)
    before = {n: spark.read.parquet(f"{root}/{n}") for n in REALTIME_TABLES}
    expected = plain_rows(after_cleanup(before, NOW))
    held = before["feed_messages"].count()
    report = {(r.table_name, r.batch_number): r.records_deleted for r in clean_realtime(spark, root, NOW).collect()}
    assert all_rows(spark, root) == expected
    assert report["feed_messages", 1] == held - len(expected["feed_messages"]) > 0
    assert all(not r.records_deleted for r in clean_realtime(spark, root, NOW).collect())
    assert all_rows(spark, root) == expected


def test_ingest_during_cleanup_loses_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    t, messages = two_batches(spark, root)
    keep = sinks.keep_rows

    def meanwhile(*args):
        """A whole batch arrives, and one whose messages are not yet written."""
        load_messages(messages, L.endpoints(t), t["versions"], root, 2)
        spark.read.parquet(f"{root}/alerts/batch_id=2").write.parquet(f"{root}/alerts/batch_id=3")
        keep(*args)

    monkeypatch.setattr(sinks, "keep_rows", meanwhile)
    clean_realtime(spark, root, NOW)
    arrived = {n: spark.read.parquet(f"{root}/{n}/batch_id=2").count() for n in REALTIME_TABLES}
    assert arrived["feed_messages"] == messages.join(L.endpoints(t), "endpoint").count()
    assert all(arrived.values())
    unfinished = spark.read.parquet(f"{root}/alerts/batch_id=3").count()
    monkeypatch.undo()
    clean_realtime(spark, root, NOW)
    assert spark.read.parquet(f"{root}/alerts/batch_id=3").count() == unfinished == arrived["alerts"]


def test_removed_source_and_purge(spark, tmp_path):
    root = str(tmp_path)
    two_batches(spark, root)
    report = {r.data_type: r.records for r in remove_source(spark, root, 2, ["alerts"]).collect()}
    assert set(report) == {"alerts"}
    feeds = spark.read.parquet(f"{root}/feed_messages")
    alerts = spark.read.parquet(f"{root}/alerts")
    assert feeds.where("source_id = 2").count() and alerts.count()
    assert alerts.join(feeds.where("source_id = 2"), "feed_message_id").count() == 0
    assert spark.read.parquet(f"{root}/alert_translations").join(alerts, "alert_id", "left_anti").count() == 0
    purge_realtime(spark, root)
    assert not any(all_rows(spark, root).values())
    purge_realtime(spark, root)  # nothing is left to remove
    assert not any(all_rows(spark, root).values())


def test_import_upkeep_retires_old_versions(spark, tmp_path):
    t = Tables(spark, SF)
    root = str(tmp_path)
    tables = {n: typed(t, n) for n in STATIC_TABLES}
    for version in (1, 2, 3):
        sinks.write_version({n: df.withColumn("version_id", F.lit(version)) for n, df in tables.items()}, root)
    sinks.save_versions(t["versions"], root, 0)
    views, report = after_import(spark, root, NOW, keep=1)
    assert {r.refresh_status for r in views.collect()} == {"SUCCESS"}
    rows = {r.version_name: r.records_deleted for r in report.collect()}
    per_version = sum(df.count() for df in tables.values())
    assert rows == {"gtfs_2023-09-01_00:00:00": per_version, "gtfs_2023-10-01_00:00:00": 0,
                    "CLEANUP_SUMMARY": per_version}
    assert sorted(r.version_id for r in sinks.load_versions(spark, root).collect()) == [1, 2]
    held = {r.version_id for r in spark.read.parquet(f"{root}/stop_times").select("version_id").distinct().collect()}
    assert held == {1, 2}


def test_a_local_session_names_a_shared_folder(monkeypatch):
    """Settings of a new session; the one of the tests is left alone."""
    from pyspark.sql import SparkSession

    from headway import session

    asked = {}

    class Builder:
        def __getattr__(self, name):
            return lambda *a: (asked.update([a]) if name == "config" else None) or self

    monkeypatch.setattr(SparkSession, "builder", Builder())
    monkeypatch.setattr(Builder, "sparkContext", Builder(), raising=False)
    session.build_session("x")
    assert asked["spark.checkpoint.dir"].startswith("/")
    session.build_session("x", **{"spark.checkpoint.dir": "/given"})
    assert asked["spark.checkpoint.dir"] == "/given"
