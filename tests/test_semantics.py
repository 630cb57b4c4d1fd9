"""Rules that are easy to get wrong, on small hand-made tables."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from headway.functions import clocks as C, codes, texts as X
from headway.operators import departures as D, retention as K, services as S, stops as P, versions as V

WEEK = "monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int"
DAILY = (1,) * 7
MONDAY = dt.date(2024, 1, 15)


def calendars(spark, calendar, dates):
    c = spark.createDataFrame(
        [(s, 2, 1, *days, dt.date(2024, 1, 1), dt.date(2024, 12, 31)) for s, days in calendar],
        f"service_id string, source_id int, version_id int, {WEEK}, start_date date, end_date date")
    d = spark.createDataFrame([(s, 2, 1, day, kind) for s, day, kind in dates],
                              "service_id string, source_id int, version_id int, date date, exception_type int")
    return c, d


def test_removal_wins_for_lists_addition_wins_for_one(spark):
    both = [("X", MONDAY, 1), ("X", MONDAY, 2)]
    c, d = calendars(spark, [("X", DAILY), ("Y", DAILY)], both + [("Y", MONDAY, 2), ("Z", MONDAY, 1)])
    active = {r.service_id for r in S.active_services(c, d, F.lit(MONDAY)).collect()}
    assert active == {"Z"}
    state = {r.service_id: r.is_active for r in S.service_activity(c, d, F.lit(MONDAY)).collect()}
    assert state == {"X": True, "Y": False, "Z": True}


def test_unknown_service_is_not_active(spark):
    c, d = calendars(spark, [("X", DAILY)], [("X", MONDAY, 2)])
    v = spark.createDataFrame([(1, True)], "version_id int, is_active boolean")
    out = S.is_service_active({"calendar": c, "calendar_dates": d, "versions": v}, 2, "nope", F.lit(MONDAY))
    assert [r.is_active for r in out.collect()] == [False]


def timetable(spark, times, numbers=None):
    """One trip T of a daily service calling at S1 then S9 at the given departure seconds."""
    c, d = calendars(spark, [("X", DAILY)], [("none", MONDAY, 2)])
    tables = {
        "versions": spark.createDataFrame([(1, True), (2, False)], "version_id int, is_active boolean"),
        "stops": spark.createDataFrame(
            [("S1", 2, 1, "One", "P"), ("S9", 2, 1, "Nine", None), ("P", 2, 1, "Parent", None)],
            "stop_id string, source_id int, version_id int, stop_name string, parent_station string"),
        "routes": spark.createDataFrame(
            [("R", 2, 1, "A", "1", "Line", 0, None, None)],
            "route_id string, source_id int, version_id int, agency_id string, route_short_name string, "
            "route_long_name string, route_type int, route_color string, route_text_color string"),
        "agency": spark.createDataFrame(
            [("A", 2, 1, "Agency", "Australia/Melbourne")],
            "agency_id string, source_id int, version_id int, agency_name string, agency_timezone string"),
        "trips": spark.createDataFrame(
            [(f"T{i}", 2, 1, "R", "X", "head", 0) for i in range(len(times))],
            "trip_id string, source_id int, version_id int, route_id string, service_id string, "
            "trip_headsign string, direction_id int"),
        "stop_times": spark.createDataFrame(
            [row for i, t in enumerate(times) for row in
             ((f"T{i}", 2, 1, "S1", 1, t, t, None, 0, 0), (f"T{i}", 2, 1, "S9", 2, t + 60, t + 60, None, 0, 0))],
            "trip_id string, source_id int, version_id int, stop_id string, stop_sequence int, "
            "arrival_time_seconds int, departure_time_seconds int, stop_headsign string, pickup_type int, "
            "drop_off_type int"),
        "calendar": c, "calendar_dates": d, "platform_numbers": numbers}
    return tables


def test_overnight_boundary(spark):
    # 00:00:10 local on Monday: Sunday's runs at 86399 are over, at 86410 still due.
    tables = timetable(spark, [86399, 86410, 5, 86400 + 9])
    out = D.get_stop_departures(tables, "S1", 2, "2024-01-14 13:00:10").collect()
    got = [(r.trip_id, r.scheduled_departure_time_seconds, r.scheduled_departure_time) for r in out]
    assert got == [("T1", 10, "00:00:10"), ("T0", 86399, "23:59:59"), ("T3", 86409, "00:00:09"),
                   ("T1", 86410, "00:00:10")]


def test_parent_lists_platforms_and_last_stop_is_no_departure(spark):
    tables = timetable(spark, [30000])
    out = D.get_stop_departures(tables, "P", 2, "2024-01-14 21:00:00").collect()
    assert [(r.stop_id, r.platform_id, r.stop_name) for r in out] == [("P", "S1", "One")]
    assert D.get_stop_departures(tables, "S9", 2, "2024-01-14 21:00:00").count() == 0


def test_platform_number_only_in_the_numbered_source(spark):
    numbers = spark.createDataFrame([("S1", "4")], "platform_id string, platform_number string")
    tables = timetable(spark, [30000], numbers)
    assert [r.platform_id for r in D.get_stop_departures(tables, "S1", 2, "2024-01-14 21:00:00").collect()] == ["4"]
    calls = spark.createDataFrame([("S1", 3)], "stop_id string, source_id int")
    assert P.platform_label(calls, numbers).first().platform_id == "S1"


def test_board_matches_single_stop_queries(spark):
    tables = timetable(spark, [28000 + 97 * i for i in range(60)])
    board = D.departure_board(tables, "2024-01-14 21:00:00", 20).drop("position")
    for stop in ("S1", "P"):
        one = D.get_stop_departures(tables, stop, 2, "2024-01-14 21:00:00", 20)
        same = board.where(F.col("stop_id") == stop)
        assert sorted(map(repr, one.collect())) == sorted(map(repr, same.collect()))


def test_no_active_version_means_no_rows(spark):
    tables = timetable(spark, [30000])
    tables["versions"] = tables["versions"].withColumn("is_active", F.lit(False))
    assert D.get_stop_departures(tables, "S1", 2, "2024-01-14 21:00:00").count() == 0
    assert D.get_stop_departures(tables, "S1", 2, "2024-01-14 21:00:00", version_id=1).count() == 1


def test_daylight_saving_uses_the_wall_clock(spark):
    moments = [("2024-04-06 15:30:00", 9000), ("2024-04-06 16:30:00", 9000), ("2024-10-05 15:59:59", 7199),
               ("2024-10-05 16:00:00", 10800)]
    for text, seconds in moments:
        clock = C.service_clock(text)
        assert spark.range(1).select(clock.seconds).first()[0] == seconds, text


def test_activation(spark):
    v = spark.createDataFrame([(1, True), (2, False), (3, False)], "version_id int, is_active boolean")
    assert [r.version_id for r in V.activate_version(v, 3).where("is_active").collect()] == [3]
    with pytest.raises(Exception, match="version 9 not found"):
        V.activate_version(v, 9).collect()


def test_nothing_to_delete_leaves_no_summary(spark):
    v = spark.createDataFrame([(1, "a", True, dt.datetime(2024, 1, 1))],
                              "version_id int, version_name string, is_active boolean, created_at timestamp")
    t = spark.createDataFrame([(1,)], "version_id int")
    assert V.delete_versions(v, {"trips": t}).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 100)), min_size=1, max_size=30))
def test_kept_and_dropped_make_the_whole(spark, ages):
    now = dt.datetime(2024, 1, 31)
    rows = [(i, None if a is None else now - dt.timedelta(days=a)) for i, a in enumerate(ages)]
    updates = spark.createDataFrame(rows, "id int, timestamp timestamp")
    limit = K.cutoff("2024-01-31 00:00:00", 7)
    kept, gone = K.keep_trip_updates(updates, limit), K.drop_trip_updates(updates, limit)
    assert sorted(r.id for r in kept.unionByName(gone).collect()) == list(range(len(ages)))
    assert {r.id for r in gone.collect()} == {i for i, a in enumerate(ages) if a is not None and a > 7}


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 86399), min_size=1, max_size=40))
def test_clock_round_trip(spark, seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "s int")
    back = df.select("s", C.gtfs_time_to_seconds(C.seconds_to_clock(F.col("s"))).alias("t")).collect()
    assert all(r.s == r.t for r in back)


def test_time_texts(spark):
    cases = {"25:10:00": 90600, "7:05:09": 25509, "-1:30:00": -1800, "+1:0:0": 3600, "1:2": None, "1:2:3:4": None,
             "": None, " 1:00:00": None, "1:00:00\n": None, "99999999999999999999:0:0": None,
             "9999999999:0:0": None, "1:61:61": 7321}
    df = spark.createDataFrame(list(cases.items()), "t string, want int")
    out = df.withColumn("got", C.gtfs_time_to_seconds(F.col("t"))).collect()
    assert [(r.t, r.got) for r in out if r.got != r.want] == []


def test_code_names(spark):
    row = spark.range(1).select(
        codes.code_label("trip_relationship", F.lit(5)), codes.code_label("trip_relationship", F.lit(4)),
        codes.code_label("effect", F.lit(11)), codes.code_label("cause", F.lit(None).cast("int"))).first()
    assert tuple(row) == ("REPLACEMENT", None, "ACCESSIBILITY_ISSUE", None)


def test_iso_text(spark):
    row = spark.sql("SELECT timestamp'2024-01-01 10:00:00' AS a, timestamp'2024-01-01 10:00:00.120000' AS b")
    assert tuple(row.select(C.iso_utc(F.col("a")), C.iso_utc(F.col("b"))).first()) == (
        "2024-01-01T10:00:00+00:00", "2024-01-01T10:00:00.12+00:00")


def test_trigrams_are_padded_words(spark):
    row = spark.range(1).select(X.trigrams(F.lit("Cat, a")), X.trigrams(F.lit("--")), X.trigrams(F.lit("ab"))).first()
    assert sorted(row[0]) == sorted(["  c", " ca", "cat", "at ", "  a", " a "])
    assert list(row[1]) == [] and sorted(row[2]) == ["  a", " ab", "ab "]


def test_unaccent(spark):
    assert spark.range(1).select(X.unaccent(F.lit("Éirinn Łódź Straße æ"))).first()[0] == "Eirinn Lodz Strasse ae"


def test_cells_lose_every_kind_of_blank(spark):
    frame = spark.createDataFrame([("\u3000\u2003 5\u202f\u1680",)], "x string")
    assert frame.select(X.cell(F.col("x"))).first()[0] == "5"


def test_clock_arguments():
    assert D._clock_argument("08:30") == 30600 and D._clock_argument("24:00:00") == 86400
    for wrong in ("24:00:01", "8:60", "25:00"):
        with pytest.raises(ValueError):
            D._clock_argument(wrong)


def test_stops_across_the_date_line_are_near(spark):
    from headway.operators.search import vehicles_near_stops
    stops = spark.createDataFrame([(1, "east", 0.0, 179.999), (1, "west", 0.0, -179.999)],
                                  "source_id int, stop_id string, stop_lat double, stop_lon double")
    units = spark.createDataFrame([("a", 1, 0.0, 179.9995), ("b", 1, 0.0, -179.9995), ("c", 1, 0.0, 0.0)],
                                  "id string, source_id int, latitude double, longitude double")
    found = {r["id"]: (r["nearest_stop_id"], r["stops_near"])
             for r in vehicles_near_stops(units, stops, 500.0, ["id"]).collect()}
    assert found == {"a": ("east", 2), "b": ("west", 2)}


def test_a_stamp_out_of_range_is_null(spark):
    frame = spark.createDataFrame([(1705276800,), (1705276800 * 10 ** 9,), (None,)], "x long")
    found = [r[0] for r in frame.select(C.posix_to_timestamp(F.col("x"))).collect()]
    assert found[0] is not None and found[1:] == [None, None]


def test_unreadable_messages_are_listed(spark, tmp_path):
    from headway.sources.feeds import rejected_messages, scan_feed_messages
    (tmp_path / "m.json").write_text(
        '{"endpoint": "tram_trip_updates", "received_at": "2024-01-14T21:00:00+00:00",'
        ' "message": {"header": {"gtfs_realtime_version": "2.0"}}}\n'
        'not json at all\n'
        '{"endpoint": "x", "received_at": "2024-01-14T21:00:00+00:00", "error": "timeout"}\n'
        '{"endpoint": "y", "received_at": "2024-01-14T21:00:00+00:00"}\n')
    found = {(r["reason"], r["raw"]) for r in rejected_messages(spark, str(tmp_path)).collect()}
    assert found == {("unreadable line", "not json at all"), ("failed fetch", None), ("no message", None)}
    assert scan_feed_messages(spark, str(tmp_path)).count() == 1


def test_messages_in_either_form_of_json(spark, tmp_path):
    from headway.sources.feeds import rejected_messages, scan_feed_messages, stream_all_messages
    plain = ('{"endpoint": "tram_service_alerts", "received_at": "2024-01-14T21:00:00+00:00", "message":'
             ' {"header": {"gtfs_realtime_version": "2.0", "incrementality": "DIFFERENTIAL", "timestamp": 1705276800},'
             ' "entity": [{"id": "A", "is_deleted": true, "alert": {"cause": 4, "effect": 99, "severity_level": 3,'
             ' "active_period": [{"start": 5, "end": 9000000000}], "informed_entity": [{"route_id": "R",'
             ' "direction_id": 1, "trip": {"trip_id": "T", "schedule_relationship": 3}}]}}]}}')
    usual = ('{"endpoint": "tram_service_alerts", "received_at": "2024-01-14T21:00:00+00:00", "message":'
             ' {"header": {"gtfsRealtimeVersion": "2.0", "incrementality": 1, "timestamp": "1705276800"},'
             ' "entity": [{"id": "A", "isDeleted": true, "alert": {"cause": "STRIKE", "effect": 99, "severityLevel": "WARNING",'
             ' "activePeriod": [{"start": "5", "end": "9000000000"}], "informedEntity": [{"routeId": "R",'
             ' "directionId": "1", "trip": {"tripId": "T", "scheduleRelationship": "CANCELED"}}]}}]}}')
    bad = usual.replace("STRIKE", "NO_SUCH_CAUSE")
    for name, text in (("plain", plain), ("usual", usual), ("bad", bad)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "m.json").write_text(text + "\n")
    one, other = [scan_feed_messages(spark, str(tmp_path / x)).collect() for x in ("plain", "usual")]
    assert one == other and len(one) == 1
    alert = one[0].message.entity[0].alert
    assert (alert.cause, alert.effect, alert.active_period[0].end) == (4, 99, 9000000000)
    assert scan_feed_messages(spark, str(tmp_path / "bad")).count() == 0
    refused = rejected_messages(spark, str(tmp_path / "bad")).collect()
    assert [r.reason for r in refused] == ["unreadable line"] and "NO_SUCH_CAUSE" in refused[0].raw
    assert stream_all_messages(spark, str(tmp_path / "bad")).columns == [
        "endpoint", "received_at", "error", "message", "_raw"]


def test_delay_of_the_right_call_day_and_time(spark):
    """A trip that calls twice at a stop; stale, late and other days' updates."""
    departures = spark.createDataFrame(
        [("T", 2, "S1", 1, 0, 100), ("T", 2, "S1", 5, 0, 900), ("T", 2, "S1", 5, 1, 50),
         ("T", 2, "S7", 7, 0, 990), ("U", 2, "S1", 1, 0, 100)],
        "trip_id string, source_id int, stop_id string, stop_sequence int, day_offset int, "
        "scheduled_departure_time_seconds int")
    at = lambda text: dt.datetime.fromisoformat(text)
    feeds = spark.createDataFrame(
        [(1, 2, at("2024-01-14 20:30:00")), (2, 2, at("2024-01-14 20:50:00")),
         (3, 2, at("2023-12-01 20:50:00")), (4, 2, at("2024-01-14 21:00:01")),
         (5, 3, at("2024-01-14 20:59:00")), (6, 2, at("2024-01-14 20:00:00"))],
        "feed_message_id int, source_id int, received_at timestamp")
    trips = spark.createDataFrame(
        [(1, 1, "T", MONDAY), (2, 2, "T", MONDAY), (3, 3, "T", dt.date(2023, 12, 1)), (4, 4, "T", MONDAY),
         (5, 5, "T", MONDAY), (6, 2, "U", dt.date(2024, 1, 13)), (7, 6, "U", MONDAY), (8, 2, "T", None)],
        "trip_update_id int, feed_message_id int, trip_id string, start_date date")
    stops = spark.createDataFrame(
        [(1, 1, "S1", 77), (2, 1, "S1", 10), (2, 5, "S1", 500), (3, 1, "S1", 9000), (4, 1, "S1", 8000),
         (5, 1, "S1", 7000), (6, 1, "S1", 6000), (7, 1, "S1", 5000), (8, -1, "S7", 40), (8, -1, "S1", 33)],
        "trip_update_id int, stop_sequence int, stop_id string, arrival_delay int").selectExpr(
            "*", "cast(null as int) AS departure_delay", "0 AS schedule_relationship")
    updates = D.latest_stop_updates(stops, trips, feeds, "2024-01-14 21:00:00")
    out = D.departures_with_delay(departures, updates)
    got = {(r.trip_id, r.stop_sequence, r.day_offset): r.arrival_delay for r in out.collect()}
    # Yesterday's run is only named by the update without a start date, which names the stop.
    assert got == {("T", 1, 0): 10, ("T", 5, 0): 500, ("T", 5, 1): 33, ("T", 7, 0): 40, ("U", 1, 0): None}
    assert D.departures_with_delay(departures, updates.limit(0)).where("updated_at is not null").count() == 0
