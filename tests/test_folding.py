"""Folding of closed days: no row lost or doubled, whatever breaks off or runs beside it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import live_queries as L
from catalog import messages as M
from catalog.derived import Tables
from headway.operators.retention import cascade, keep_feed_messages
from headway.plans import folding
from headway.plans.feed_load import load_messages
from headway.schemas import REALTIME_TABLES
from headway.sources import sinks

SF = "/root/testdata/sf0.001"
NOW = "2024-01-30 00:00:00"


def rows(spark, root):
    live = sinks.read_batches(spark, root, REALTIME_TABLES)
    return {n: sorted(map(str, live[n].select(*sorted(set(live[n].columns) - {"batch_id"})).collect()))
            for n in REALTIME_TABLES}


def batches(spark, root):
    return {r.batch_id for r in sinks.read_batches(spark, root, [])["feed_messages"]
            .select("batch_id").distinct().collect()}


@pytest.fixture
def stored(spark, tmp_path):
    t, root = Tables(spark, SF), str(tmp_path)
    messages = M.feed_messages(t).where("error is null and message is not null")
    first = F.col("received_at") < "2024-01-16"
    clock = F.col("received_at") - F.date_trunc("day", "received_at")  # all on one day, at their time
    messages = messages.withColumn("received_at", F.when(
        first, F.lit("2024-01-15").cast("timestamp") + clock).otherwise(F.col("received_at"))).persist()
    parts = [first & (F.hour("received_at") % 3 == i) for i in range(3)] + [~first]
    for number, part in enumerate(parts):
        load_messages(messages.where(part), L.endpoints(t), t["versions"], root, number)
    yield t, root, messages
    messages.unpersist()


def test_small_batches_of_a_day_become_one(spark, stored):
    t, root, messages = stored
    before = rows(spark, root)
    report = folding.fold_days(spark, root, NOW).collect()
    assert [(r.had, r.has) for r in report] == [(3, 1)]
    assert rows(spark, root) == before and all(before.values())
    assert batches(spark, root) == {-1, 3}  # the newest stays as its job left it
    # Old folders stay for readers that began before; the next run deletes them, and refolds nothing.
    assert {0, 1, 2, -1, 3} <= set(sinks.folder_numbers(spark, f"{root}/alerts", "batch_id"))
    assert [(r.had, r.has) for r in folding.fold_days(spark, root, NOW).collect()] == [(1, 1)]
    assert set(sinks.folder_numbers(spark, f"{root}/alerts", "batch_id")) == {-1, 3}
    assert rows(spark, root) == before
    # Messages that come again are known, though their batch was folded.
    load_messages(messages, L.endpoints(t), t["versions"], root, 4)
    assert rows(spark, root) == before


def test_a_fold_that_breaks_off_changes_nothing(spark, stored, monkeypatch):
    _, root, _ = stored
    before = rows(spark, root)

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(folding, "_commit", lost)
    with pytest.raises(RuntimeError):
        folding.fold_days(spark, root, NOW)
    monkeypatch.undo()
    assert -1 in sinks.folder_numbers(spark, f"{root}/feed_messages", "batch_id")
    assert rows(spark, root) == before and batches(spark, root) == {0, 1, 2, 3}
    folding.fold_days(spark, root, NOW)
    assert rows(spark, root) == before and batches(spark, root) == {-1, 3}


def test_a_reader_that_began_before_keeps_its_rows(spark, stored):
    _, root, _ = stored
    before = rows(spark, root)
    live = sinks.read_batches(spark, root, REALTIME_TABLES)
    folding.fold_days(spark, root, NOW)
    assert live["trip_updates"].count() == len(before["trip_updates"])


def test_batches_large_enough_and_open_days_stay(spark, stored):
    _, root, _ = stored
    assert folding.fold_days(spark, root, "2024-01-15 12:00:00").count() == 0
    folding.fold_days(spark, root, NOW, target_rows=1)
    assert batches(spark, root) == {0, 1, 2, 3}


def test_whole_days_go_as_the_cascade_would(spark, stored):
    _, root, _ = stored
    folding.fold_days(spark, root, NOW)
    live = sinks.read_batches(spark, root, REALTIME_TABLES)
    newest = live["feed_messages"].where("batch_id = -1").agg(F.max("timestamp")).scalar()
    undated = live["feed_messages"].where("batch_id = -1 and timestamp is null").count()
    kept = live["feed_messages"].where("batch_id <> -1")
    expected = {n: df.count() for n, df in cascade(live, kept).items()}
    limit = "2024-02-20 00:00:00"
    assert undated == 0 and live["feed_messages"].select((newest < F.lit(limit)).alias("x")).first().x
    assert keep_feed_messages(live["feed_messages"].where("batch_id = -1"), F.lit(limit).cast("timestamp")).isEmpty()
    had = {n: df.count() for n, df in live.items()}
    assert folding.drop_days(spark, root, "2023-01-01 00:00:00").agg(F.sum("records_deleted")).first()[0] == 0
    report = {r.table_name: r.records_deleted for r in folding.drop_days(spark, root, limit).collect()}
    assert report == {n: had[n] - expected[n] for n in REALTIME_TABLES} and report["feed_messages"]
    assert {n: len(r) for n, r in rows(spark, root).items()} == expected
    folding.fold_days(spark, root, NOW)
    assert set(sinks.folder_numbers(spark, f"{root}/feed_messages", "batch_id")) == {3}
