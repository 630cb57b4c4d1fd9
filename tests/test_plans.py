"""What the physical plans must and must not hold, and results on skewed keys."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.derived import Tables
from catalog.schedule_queries import schedule
from headway.operators import departures as D, search as G, services as S, stops as P
from headway.sources import sinks

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in entry.queries()
                                  if n[0] not in "SKW" or n.startswith("S5")])
def test_no_all_pairs_joins(spark, physical, name):
    plan = physical(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_board_ranks_before_it_shuffles(spark, physical):
    plan = physical(D.departure_board(schedule(Tables(spark, SF)), "2024-01-14 21:00:00", 10))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def stored_schedule(spark, root):
    t = Tables(spark, SF)
    names = ["stops", "routes", "trips", "stop_times", "calendar", "calendar_dates", "agency"]
    sinks.write_version(t.pick(*names), str(root))
    return {**sinks.read_version_tables(spark, str(root), names), "versions": t["versions"],
            "platform_numbers": t["platform_numbers"]}


def test_stored_tables_prune_and_push_down(spark, physical, tmp_path):
    tables = stored_schedule(spark, tmp_path)
    plan = physical(D.get_scheduled_stop_times(tables, 2, "S5", "2024-01-14 21:00:00", version_id=2))
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "arrival_time_seconds" in x)
    assert "version_id" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(stop_id,S5)" in scan and "GreaterThanOrEqual(arrival_time_seconds,0)" in scan
    assert "drop_off_type" not in scan.split("ReadSchema")[1]
    board = physical(D.get_stop_departures(tables, "S5", 2, "2024-01-14 21:00:00"))
    assert "GreaterThanOrEqual(departure_time_seconds,28800)" in board
    told = [x for x in board.splitlines() if "FileScan" in x and "departure_time_seconds" in x]
    assert told and all("In(stop_id, [S5," in x for x in told)


def test_a_stop_with_more_platforms_than_are_told(spark, monkeypatch):
    tables = schedule(Tables(spark, SF))
    want = D.get_stop_departures(tables, "S5", 2, "2024-01-14 21:00:00").collect()
    monkeypatch.setattr(D, "TOLD", 1)
    assert D.get_stop_departures(tables, "S5", 2, "2024-01-14 21:00:00").collect() == want and want
    assert D.get_stop_departures(tables, "nowhere", 2, "2024-01-14 21:00:00").collect() == []


def test_stored_and_derived_tables_answer_alike(spark, tmp_path):
    tables = stored_schedule(spark, tmp_path)
    a = D.get_stop_departures(tables, "S5", 2, "2024-01-14 21:00:00")
    b = D.get_stop_departures(schedule(Tables(spark, SF)), "S5", 2, "2024-01-14 21:00:00")
    assert a.collect() == b.select(*a.columns).collect()


def test_one_stop_with_a_third_of_all_calls(spark):
    """A busy stop gives the same rows whether or not joins may broadcast."""
    t = Tables(spark, SF)
    tables = schedule(t)
    hot = tables["stop_times"].withColumn(
        "stop_id", F.when(F.xxhash64("trip_id", "stop_sequence") % 3 == 0, "S5").otherwise(F.col("stop_id")))
    tables["stop_times"] = hot
    board = D.departure_board(tables, "2024-01-14 21:00:00", 7)
    routes = P.stop_routes(tables)
    want = sorted(map(repr, board.collect())), sorted(map(repr, routes.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    try:
        again = D.departure_board(tables, "2024-01-14 21:00:00", 7), P.stop_routes(tables)
        assert (sorted(map(repr, again[0].collect())), sorted(map(repr, again[1].collect()))) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    assert max(r["count"] for r in board.groupBy("source_id", "stop_id").count().collect()) == 7


def metres(lat1, lon1, lat2, lon2):
    a, b, c, d = map(math.radians, (lat1, lon1, lat2, lon2))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * G.EARTH_RADIUS * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("lat, spread, radius", [(-37.8, 0.2, 900), (0.0, 0.3, 5000), (61.0, 0.4, 12000),
                                                 (-84.0, 1.0, 30000)])
def test_grid_join_equals_brute_force(spark, lat, spread, radius):
    rng = random.Random(7)
    place = lambda: (lat + rng.uniform(-spread, spread), 144.9 + rng.uniform(-spread, spread))
    stops = [(f"S{i}", 1, *place()) for i in range(60)]
    vehicles = [(i, 1, *place()) for i in range(150)]
    vehicles += [(1000 + i, 1, *vehicles[0][2:]) for i in range(100)]  # a depot
    got = G.vehicles_near_stops(
        spark.createDataFrame(vehicles, "id int, source_id int, latitude double, longitude double"),
        spark.createDataFrame(stops, "stop_id string, source_id int, stop_lat double, stop_lon double"),
        radius, ["id"])
    want = {}
    for vid, _, y, x in vehicles:
        near = sorted((metres(y, x, sy, sx), s) for s, _, sy, sx in stops if metres(y, x, sy, sx) <= radius)
        if near:
            want[vid] = (near[0][1], len(near))
    assert {r.id: (r.nearest_stop_id, r.stops_near) for r in got.collect()} == want


def test_saved_trip_ends_give_the_same_board(spark, tmp_path):
    tables = stored_schedule(spark, tmp_path)
    sinks.write_version({"trip_ends": P.last_sequences(tables["stop_times"])}, str(tmp_path))
    ends = sinks.read_version_tables(spark, str(tmp_path), ["trip_ends"])
    for query in (lambda t: D.departure_board(t, "2024-01-14 21:00:00", 5),
                  lambda t: D.get_stop_departures(t, "S5", 2, "2024-01-14 21:00:00")):
        a, b = query(tables), query({**tables, **ends})
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_bucketed_tables_join_without_a_shuffle(spark, physical):
    t = Tables(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS transit")
    sinks.save_bucketed({"stop_times": t["stop_times"], "trips": t["trips"],
                         "trip_ends": P.last_sequences(t["stop_times"])}, "transit", 4)
    stored = {n: spark.table(f"transit.{n}") for n in ("stop_times", "trip_ends")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        kept = P.before_last_stop(stored["stop_times"], stored["trip_ends"])
        assert "Exchange" not in physical(kept)
        want = P.before_last_stop(t["stop_times"])
        assert sorted(map(repr, kept.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        spark.sql("DROP DATABASE transit CASCADE")
