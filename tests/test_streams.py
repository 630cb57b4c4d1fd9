"""Streams over files that arrive one by one give what the batch operators give."""

from __future__ import annotations

import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.sql import DataFrame, functions as F

from headway.operators import events as N, realtime_rows as R
from headway.plans.feed_load import realtime_tables
from headway.schemas import REALTIME_TABLES
from headway.sources import feeds, lookups, sinks
from headway.streaming import jobs

START = dt.datetime(2024, 1, 15, 0, 0, 0)


def trip_update(entity, trip, stops):
    return {"id": entity, "trip_update": {
        "trip": {"trip_id": trip, "route_id": "R1", "start_time": "25:00:00", "start_date": "20240115"},
        "timestamp": 1705276800,
        "stop_time_update": [{"stop_sequence": q, "stop_id": s, "arrival": {"delay": 60},
                              "departure": {"delay": 90, "time": 1705276900}} for q, s in stops]}}


def vehicle(entity, unit, lat, stamp, **more):
    return {"id": entity, "vehicle": {"trip": {"trip_id": "T1"}, "vehicle": {"id": unit},
                                      "position": {"latitude": lat, "longitude": 144.9},
                                      "timestamp": stamp, **more}}


def message(endpoint, minute, entities, stamp=True, **more):
    at = START + dt.timedelta(minutes=minute)
    header = {"gtfs_realtime_version": "2.0", "incrementality": "FULL_DATASET"}
    if stamp:
        header["timestamp"] = int(at.replace(tzinfo=dt.timezone.utc).timestamp())
    return {"endpoint": endpoint, "received_at": at.strftime("%Y-%m-%dT%H:%M:%S.000001Z"),
            "message": {"header": header, "entity": entities}, **more}


ALERT = {"id": "A1", "alert": {
    "active_period": [{"start": 1, "end": 2}, {"start": 3}], "cause": 9, "effect": 4, "severity_level": 3,
    "informed_entity": [{"route_id": "R1", "stop_id": "S1"}, {"route_id": "R1", "stop_id": "S2"},
                        {"trip": {"trip_id": "T1", "start_time": "1:00:00", "start_date": "x"}}],
    "url": {"translation": [{"text": "https://n"}]},
    "header_text": {"translation": [{"text": "Works", "language": "en"}, {"text": "Travaux", "language": "fr"}]}}}

FILES = [
    [message("tram_trip_updates", 0, [trip_update("E1", "T1", [(1, "S1"), (2, "S2")]), trip_update("E2", "T2", [])]),
     {"endpoint": "tram_trip_updates", "received_at": "2024-01-15T00:00:30.000000Z", "error": "timeout"},
     message("mystery_feed", 1, [trip_update("E9", "T9", [(1, "S9")])])],
    [message("tram_vehicle_positions", 5, [
        vehicle("V1", "tram-1", -37.8136123, 1705277000, stop_id="S1", current_status=1),
        vehicle("V2", "tram-2", -37.9, 1705277000), {"id": "V3", "vehicle": {"vehicle": {"id": "tram-3"}}},
        {"id": "V4"}]),
     message("tram_service_alerts", 6, [ALERT, {"id": "A2", "alert": {"cause": 1}}], stamp=False)],
    [message("tram_vehicle_positions", 10, [vehicle("V1", "tram-1", -37.8, 1705277300)]),
     message("metrotrain_trip_updates", 40, [
         {"id": "E1", "trip_update": {"trip": {"route_id": "R1"}}},
         {"id": "E2", "trip_update": {"trip": {"trip_id": "T1"}, "stop_time_update": [{"stop_id": None}]}}])],
]


@pytest.fixture(scope="module")
def arrivals(tmp_path_factory):
    root = tmp_path_factory.mktemp("arrivals")
    for i, lines in enumerate(FILES):
        path = root / f"{i}.json"
        path.write_text("\n".join(json.dumps(x) for x in lines))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(root)


@pytest.fixture(scope="module")
def endpoints(spark):
    return feeds.endpoints_dim(spark, lookups.transport_sources(spark)).persist()


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame([(1, False), (2, True)], "version_id int, is_active boolean")


@pytest.fixture(scope="module")
def batch(spark, arrivals, endpoints, versions):
    tagged = feeds.tag_messages(feeds.scan_feed_messages(spark, arrivals), endpoints, versions)
    return realtime_tables(tagged)


def rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def one_by_one(spark, arrivals):
    return feeds.stream_feed_messages(spark, arrivals, maxFilesPerTrigger="1")


def test_flattened_rows(batch):
    assert {n: batch[n].count() for n in REALTIME_TABLES} == {
        "feed_messages": 5, "vehicle_positions": 3, "trip_updates": 3, "stop_time_updates": 3, "alerts": 2,
        "alert_active_periods": 2, "alert_informed_entities": 3, "alert_translations": 3}
    first = batch["trip_updates"].where("trip_id = 'T1' and route_id = 'R1'").first()
    assert (first.start_time, first.start_date, first.entity_id) == (90000, dt.date(2024, 1, 15), "E1")
    bare = batch["stop_time_updates"].where("stop_id = ''").first()
    assert bare.stop_sequence == -1 and bare.arrival_delay is None
    position = batch["vehicle_positions"].where("latitude < -37.81 and latitude > -37.82").first()
    assert abs(float(position.latitude) + 37.8136123) < 2e-6
    alert_feed = batch["feed_messages"].where("feed_type = 'service_alerts'").first()
    assert alert_feed.timestamp == alert_feed.received_at
    assert rows(batch["alert_translations"], "field_type", "language", "text") == [
        ("header_text", "en", "Works"), ("header_text", "fr", "Travaux"), ("url", "", "https://n")]
    assert rows(batch["alert_active_periods"], "start_time", "end_time") == [(1, 2), (3, None)]


def test_entities_are_built_once(spark, arrivals, endpoints, versions, physical):
    """No filter on the list of entities, for which they would all be built once more."""
    tagged = feeds.tag_messages(feeds.scan_feed_messages(spark, arrivals), endpoints, versions)
    for rows in (R.vehicle_positions, R.trip_updates, R.alerts, R.alert_active_periods):
        plan = physical(rows(tagged)).split("== Physical Plan ==")[1]
        assert plan.count("transform(message") == 1
        assert "size(" not in plan.split("Generate explode")[-1]


def test_messages_without_entities_give_no_rows(spark, endpoints, versions, tmp_path):
    head = '{"endpoint": "tram_trip_updates", "received_at": "2024-01-15T00:00:0%dZ", "message": {"header": {}%s}}'
    (tmp_path / "m.json").write_text("\n".join(
        head % pair for pair in enumerate(["", ', "entity": []', ', "entity": [null]', ', "entity": [{"id": "a"}]'])))
    tagged = feeds.tag_messages(feeds.scan_feed_messages(spark, str(tmp_path)), endpoints, versions)
    assert R.feed_messages(tagged).count() == 4
    assert R.trip_updates(tagged).count() == R.stop_time_updates(tagged).count() == 0


def test_unknown_endpoint_is_reported(spark, arrivals, endpoints):
    messages = feeds.scan_feed_messages(spark, arrivals)
    assert [r.endpoint for r in feeds.unknown_endpoints(messages, endpoints).collect()] == ["mystery_feed"]


def test_no_active_version_is_an_error(spark, arrivals, endpoints, versions):
    idle = versions.withColumn("is_active", F.lit(False))
    with pytest.raises(Exception, match="no active version"):
        feeds.tag_messages(feeds.scan_feed_messages(spark, arrivals), endpoints, idle).collect()


def test_ingest_equals_batch(spark, arrivals, endpoints, versions, batch, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):  # a second run finds nothing new
        jobs.ingest_feeds(one_by_one(spark, arrivals), endpoints, lambda: versions, out,
                          str(tmp_path / "progress")).awaitTermination()
    for name in REALTIME_TABLES:
        stored = spark.read.parquet(f"{out}/{name}")
        columns = batch[name].columns
        assert rows(stored, *columns) == rows(batch[name], *columns), name
        if name == "feed_messages":
            assert stored.select("batch_id").distinct().count() == 3


def test_repeated_batch_replaces_itself(spark, batch, tmp_path):
    for _ in range(2):
        sinks.write_batch({"alerts": batch["alerts"]}, str(tmp_path), 4)
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 2


def test_events_of_messages_need_no_shuffle(spark, arrivals, endpoints, versions, physical):
    tagged = feeds.tag_messages(feeds.scan_feed_messages(spark, arrivals), endpoints, versions)
    plan = physical(N.message_events(tagged, "2024-01-15 01:00:00"))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_events_equal_batch(spark, arrivals, endpoints, versions, batch, tmp_path):
    now = "2024-01-15 01:00:00"
    out = str(tmp_path / "out")
    jobs.event_stream(one_by_one(spark, arrivals), endpoints, lambda: versions, out,
                      str(tmp_path / "progress"), now).awaitTermination()
    stored = spark.read.parquet(f"{out}/events")
    assert rows(stored, "channel", "payload", "event_time") == rows(
        N.all_events(batch, now), "channel", "payload", "event_time")
    channels = {}
    for r in stored.collect():
        channels.setdefault(r.channel, []).append(json.loads(r.payload))
    # The same route under two stops is told twice, as its selectors differ.
    assert len(channels["service_alerts_route:3:R1"]) == 2
    assert channels["stop_departures:3:S1"][0]["departure_time"] == 1705276900
    assert channels["stop_departures:3:S1"][0]["arrival_time"] is None
    assert set(channels["vehicle_at_stop:3:S1"][0]) == {
        "type", "stop_id", "vehicle_id", "trip_id", "route_id", "current_status", "timestamp"}


def test_latest_vehicle(spark, arrivals, endpoints, versions, tmp_path):
    out = str(tmp_path / "out")
    jobs.latest_vehicle(one_by_one(spark, arrivals), endpoints, versions, out,
                        str(tmp_path / "progress")).awaitTermination()
    latest = jobs.latest_per_key(spark, out, ["source_id", "vehicle_id"])
    assert [(r.vehicle_id, float(r.latitude)) for r in latest.orderBy("vehicle_id").collect()] == [
        ("tram-1", -37.7999992), ("tram-2", -37.9000015)]


def test_windows(spark, arrivals, endpoints, versions, tmp_path):
    out = str(tmp_path / "out")
    jobs.windowed_activity(one_by_one(spark, arrivals), endpoints, versions, out,
                           str(tmp_path / "progress")).awaitTermination()
    counts = jobs.latest_per_key(spark, out, ["window_start", "window_end", "source_id", "trip_id"])
    got = {(r.window_start.hour * 60 + r.window_start.minute, r.source_id, r.trip_id): r.updates
           for r in counts.where("window_start >= '2024-01-15'").collect()}
    assert got == {(0, 3, "T1"): 1, (0, 3, "T2"): 1, (0, 2, "T1"): 1, (30, 2, "T1"): 1}


def test_repeated_message_is_taken_once(spark, arrivals, endpoints, versions, tmp_path):
    import shutil
    again = tmp_path / "in"
    shutil.copytree(arrivals, again)
    repeat = json.loads(json.dumps(FILES[2][0]))
    repeat["received_at"] = "2024-01-15T00:45:00.000000Z"
    (again / "3.json").write_text(json.dumps(repeat))
    os.utime(again / "3.json", (1_700_000_009, 1_700_000_009))
    out = str(tmp_path / "out")
    jobs.distinct_entities(one_by_one(spark, str(again)), endpoints, versions, out,
                           str(tmp_path / "progress")).awaitTermination()
    once = spark.read.parquet(out)
    assert once.count() == 11
    assert once.where("feed_type = 'vehicle_positions' and entity_id = 'V1'").count() == 2


def test_recent_lookups_read_recent_batches_only(spark, arrivals, endpoints, versions, batch, physical, tmp_path):
    from headway.operators.live_trips import get_trip_realtime_data
    out = str(tmp_path / "out")
    jobs.ingest_feeds(one_by_one(spark, arrivals), endpoints, lambda: versions, out,
                      str(tmp_path / "progress")).awaitTermination()
    stored = {n: spark.read.parquet(f"{out}/{n}") for n in REALTIME_TABLES}
    now = "2024-01-15 00:45:00"
    recent = get_trip_realtime_data(stored, ["T1"], now)
    assert rows(recent, *recent.columns) == rows(get_trip_realtime_data(batch, ["T1"], now), *recent.columns)
    assert recent.count() == 1
    assert "dynamicpruning" in physical(recent)


def test_rows_no_table_would_take_refuse_their_message(spark, endpoints, versions, tmp_path):
    bare = {"id": "V9", "vehicle": {"position": {"longitude": 144.9}}}
    long_id = vehicle("V1", "v" * 101, -37.8, 1705277000)
    speechless = {"id": "A1", "alert": {"header_text": {"translation": [{"language": "en"}]}}}
    lines = [message("tram_vehicle_positions", 0, [vehicle("V1", "v" * 100, -37.8, 1705277000)]),
             message("tram_vehicle_positions", 1, [vehicle("V0", "x", -37.8, 1705277000), bare]),
             message("tram_vehicle_positions", 2, [long_id]),
             message("tram_service_alerts", 3, [speechless]),
             # The columns of another feed type are not written, so they are not judged.
             message("tram_service_alerts", 4, [bare, long_id]),
             message("tram_trip_updates", 5, [trip_update("E1", "T1", [(1, "S1"), (1, "S1")])]),
             message("tram_trip_updates", 6, [trip_update("E1", "T1", [(None, "S1"), (-1, "S1")])]),
             message("tram_trip_updates", 7, [trip_update("E1", "T1", [(1, "S1"), (1, "S2"), (2, "S1")])])]
    (tmp_path / "in.json").write_text("\n".join(json.dumps(x) for x in lines))
    judged = feeds.judge_messages(feeds.scan_feed_messages(spark, str(tmp_path / "in.json")), endpoints, versions)
    assert {r.received_at.minute: r.refusal for r in judged.collect()} == {
        0: None, 1: "position without coordinates", 2: "text too long", 3: "translation without text", 4: None,
        5: "repeated stop", 6: "repeated stop", 7: None}


def test_messages_under_one_key(spark, endpoints, versions, tmp_path):
    """One of several messages of an endpoint and moment is taken, the same in any order; a replay
    is refused whole, a batch that is run again is not; other moments are told apart."""
    from headway.plans.feed_load import load_messages
    twins = [message("tram_trip_updates", 0, [trip_update(f"E{i}", f"T{i}", [(1, "S1")])]) for i in range(4)]
    lines = [*twins, twins[0], message("metrotrain_trip_updates", 0, []), message("tram_trip_updates", 1, [])]
    taken = set()
    for name, order in (("one", lines), ("two", lines[::-1])):
        (tmp_path / f"{name}.json").write_text("\n".join(json.dumps(x) for x in order))
        read = feeds.scan_feed_messages(spark, str(tmp_path / f"{name}.json")).repartition(4)
        root = str(tmp_path / f"out-{name}")
        for batch_id in (0, 1, 0) if name == "one" else (0,):
            load_messages(read, endpoints, versions, root, batch_id)
            kept = spark.read.parquet(f"{root}/feed_messages")
            assert kept.count() == kept.select("feed_message_id").distinct().count() == 3
        taken.add(tuple(r.trip_id for r in spark.read.parquet(f"{root}/trip_updates").collect()))
        reasons = spark.read.parquet(f"{root}/rejected_messages").groupBy("batch_id", "reason").count()
        # The replay finds all messages stored, the twins too.
        replay = {(1, "stored message"): 7} if name == "one" else {}
        assert {(r.batch_id, r.reason): r["count"] for r in reasons.collect()} == {
            (0, "repeated message"): 4} | replay
    assert len(taken) == 1 and len(taken.pop()) == 1


def test_repeats_are_told_apart_without_moving_messages(spark, endpoints, versions, tmp_path, physical):
    """Of messages under one key one stays, also of equal ones; every table reads the stored batch."""
    lines = [message("tram_trip_updates", n % 4, [trip_update(f"E{n // 8}", "T1", [(1, "S1")])]) for n in range(16)]
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, lines)))
    judged = feeds.judge_messages(feeds.scan_feed_messages(spark, str(tmp_path)), endpoints, versions).persist()
    found = feeds.refuse_repeats(judged, None, DataFrame.persist)
    plan = physical(found).split("== Physical Plan ==")[1]
    assert "Union" not in plan and "Window" not in plan.split("InMemoryRelation")[0]
    rows = found.select("feed_message_id", "refusal").collect()
    assert len(rows) == 16 and found.columns == judged.columns
    assert Counter(r.refusal for r in rows) == {"repeated message": 12, None: 4}
    assert len({r.feed_message_id for r in rows if r.refusal is None}) == 4
    judged.unpersist()


def test_lines_of_other_endpoints_are_passed_over_by_the_reader(spark, arrivals, physical):
    every = feeds.scan_feed_messages(spark, arrivals)
    for feed_type in ("trip_updates", "vehicle_positions", "service_alerts"):
        named = feeds.endpoints_of(feed_type)
        found = feeds.scan_feed_messages(spark, arrivals, endpoints=named)
        assert "PushedFilters: [In(endpoint" in physical(found).replace("IsNull(error), ", "").replace(
            "IsNotNull(message), ", "")
        assert found.collect() == [r for r in every.collect() if r.endpoint in named] != []


def test_a_batch_without_messages_to_take(spark, endpoints, versions, tmp_path):
    from headway.plans.feed_load import load_messages
    path = tmp_path / "in.json"
    path.write_text(json.dumps(message("mystery_feed", 0, [])))
    for batch_id in (0, 1):
        load_messages(feeds.scan_feed_messages(spark, str(path)), endpoints, versions, str(tmp_path / "out"), batch_id)
    assert spark.read.parquet(str(tmp_path / "out/feed_messages")).count() == 0
    assert spark.read.parquet(str(tmp_path / "out/rejected_messages")).count() == 2


def test_folds_of_the_latest_rows(spark, tmp_path):
    """Rows stay the same whatever a broken-off fold has left; what is kept does not grow."""
    root, key = str(tmp_path / "log"), ["k"]

    def batch(n, rows):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("overwrite").parquet(
            f"{root}/batch_id={n}")

    def latest():
        return {r.k: r.v for r in jobs.latest_per_key(spark, root, key).collect()}

    def folders():
        return (sinks.whole_folders(spark, root, "batch_id"), sinks.whole_folders(spark, f"{root}_folded", "upto"))

    batch(0, [("a", 1), ("b", 1)])
    batch(1, [("a", 0)])
    assert latest() == {"a": 0, "b": 1}
    assert jobs.fold_latest(spark, root, key) == 2 and folders() == ([0, 1], [1])
    held = jobs.latest_per_key(spark, root, key)  # a reader from before the next fold
    assert latest() == {"a": 0, "b": 1} and jobs.fold_latest(spark, root, key) == 0
    batch(2, [("c", 7)])
    os.makedirs(f"{root}/batch_id=3")             # being written: no mark
    os.makedirs(f"{root}_folded/upto=9")          # a fold that broke off
    assert latest() == {"a": 0, "b": 1, "c": 7}
    assert jobs.fold_latest(spark, root, key) == 1 and folders() == ([2], [1, 2])
    assert {r.k: r.v for r in held.collect()} == {"a": 0, "b": 1}
    batch(1, [("a", 0)])                          # run again after it was folded
    assert latest() == {"a": 0, "b": 1, "c": 7}
    batch(3, [("b", 2), (None, 5)])
    assert jobs.fold_latest(spark, root, key) == 1 and folders() == ([3], [2, 3])
    assert latest() == {"a": 0, "b": 2, "c": 7, None: 5}
    assert len(jobs.latest_per_key(spark, root, key).inputFiles()) == len(
        spark.read.parquet(f"{root}_folded/upto=3").inputFiles())
