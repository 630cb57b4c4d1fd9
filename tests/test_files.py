"""Hand-written schedule files with the odd cells real feeds hold."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from headway.operators import static_rows as R
from headway.plans.schedule_load import load_schedule, quality_report, saved_views, typed_tables
from headway.sources import portal, sinks
from headway.sources.gtfs_files import scan_gtfs_file, scan_paths, source_from_path

FILES = {
    "1/google_transit/agency.txt": "﻿agency_id,agency_name,agency_url,agency_timezone\n"
                                   "A1, Yarra Lines ,,Australia/Melbourne\n",
    # Columns in another order, one missing (level_id), one unknown.
    "1/google_transit/stops.txt": 'stop_name,stop_id,stop_lat,stop_lon,extra,location_type,parent_station\n'
                                  '"Flinders, ""the"" station",S1,-37.8183051,144.9671,x,1,\n'
                                  "Short row,S2,0\n"
                                  '"Two\nlines",S3,abc,144.5,x,zz,S1,too,many\n',
    "1/google_transit/levels.txt": "level_id,level_index,level_name\nL0,0,Ground\nL1,-1.5,\n",
    "1/google_transit/routes.txt": "route_id,agency_id,route_short_name,route_type\nR1,A1, 96 ,0\nR2,,,bus\n",
    "1/google_transit/calendar.txt":
        "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
        "C1,1,1,1,1,1,0,0,20240101,20241231\nC2,1,1,1,1,1,0,0,20240101,2024-12-31\n"
        "C3,x,,1,1,1,0,0,20240230,20241231\n",
    "1/google_transit/calendar_dates.txt": "service_id,date,exception_type\nC1,20240115,2\nC9,2024115,1\n",
    "1/google_transit/trips.txt": "trip_id,route_id,service_id,direction_id\nT1,R1,C1,\nT2,R1,C1,1\n",
    "1/google_transit/stop_times.txt":
        "trip_id,arrival_time,departure_time,stop_id,stop_sequence,shape_dist_traveled\n"
        "T1, 7:05:09,07:05:30,S2,1,0\nT1,25:10:00,25:61:00,S3,2,12.50\n"
        "T2,aa:00:00,,S2,x,1e2\nT2,-1:00:00,7:5,S3,2,far\n",
    "1/google_transit/pathways.txt":
        "pathway_id,from_stop_id,to_stop_id,pathway_mode,is_bidirectional,traversal_time\nP1,S1,S2,8,1,0\n",
    "1/google_transit/transfers.txt":
        "from_stop_id,to_stop_id,from_route_id,transfer_type,min_transfer_time\nS1,S2,,2,0\nS1,S3,R1,5,120\n",
    "2/google_transit/agency.txt": "agency_timezone,agency_id,agency_name\nAustralia/Melbourne,B1,Bus\n",
    "docs/google_transit/agency.txt": "agency_id\nnot a source\n",
    "3/other/agency.txt": "agency_id\nwrong folder\n",
}


@pytest.fixture(scope="module")
def drop(tmp_path_factory):
    root = tmp_path_factory.mktemp("drop")
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf8")
    return str(root)


def rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def test_only_numbered_sources_are_found(spark, drop):
    found = rows(scan_paths(spark, drop).where("table_name = 'agency'"), "source_id")
    assert found == [(1,), (2,)]


def test_agency_by_header_name(spark, drop):
    out = R.agency(scan_gtfs_file(spark, drop, "agency"), 7)
    assert rows(out, "agency_id", "agency_name", "agency_url", "agency_lang", "source_id", "version_id") == [
        ("A1", "Yarra Lines", None, None, 1, 7), ("B1", "Bus", None, None, 2, 7)]


@pytest.mark.parametrize("multiline", [None, True])
def test_stops(spark, drop, multiline):
    out = R.stops(scan_gtfs_file(spark, drop, "stops", multiline=multiline), 7)
    assert rows(out, "stop_id", "stop_name", "stop_lat", "stop_lon", "location_type",
                "parent_station", "level_id") == [
        ("S1", 'Flinders, "the" station', Decimal("-37.8183051"), Decimal("144.9671000"), 1, None, None),
        ("S2", "Short row", None, None, 0, None, None),
        ("S3", "Two\nlines", None, Decimal("144.5000000"), 0, "S1", None)]


def test_split_reading_gives_the_same_rows(spark, drop):
    a, b = [scan_gtfs_file(spark, drop, "stop_times", multiline=m) for m in (False, True)]
    assert rows(a, *a.columns) == rows(b, *b.columns)


def test_stop_times(spark, drop):
    out = R.stop_times(scan_gtfs_file(spark, drop, "stop_times"), 7)
    assert rows(out, "trip_id", "stop_sequence", "arrival_time_seconds", "departure_time_seconds",
                "shape_dist_traveled", "pickup_type") == [
        ("T1", 1, 25509, 25530, None, 0), ("T1", 2, 90600, 93660, Decimal("12.50"), 0),
        ("T2", 0, None, None, Decimal("100.00"), 0), ("T2", 2, -3600, None, None, 0)]


def test_calendars_drop_unreadable_dates(spark, drop):
    calendar = R.calendar(scan_gtfs_file(spark, drop, "calendar"), 7)
    assert rows(calendar, "service_id", "end_date") == [("C1", dt.date(2024, 12, 31))]
    dates = R.calendar_dates(scan_gtfs_file(spark, drop, "calendar_dates"), 7)
    assert rows(dates, "service_id", "date", "exception_type") == [("C1", dt.date(2024, 1, 15), 2)]


def test_optional_zero_and_blank(spark, drop):
    raw = scan_gtfs_file(spark, drop, "levels")
    assert rows(R.levels(raw, 7), "level_id", "level_index", "level_name") == [
        ("L0", None, "Ground"), ("L1", -1.5, None)]
    assert rows(R.levels(raw, 7, keep_zero_level=True), "level_index") == [(-1.5,), (0.0,)]
    assert rows(R.routes(scan_gtfs_file(spark, drop, "routes"), 7), "route_id", "agency_id",
                "route_short_name", "route_type") == [("R1", "A1", "96", 0), ("R2", None, None, 0)]
    assert rows(R.transfers(scan_gtfs_file(spark, drop, "transfers"), 7), "to_stop_id", "from_route_id",
                "from_trip_id", "min_transfer_time") == [("S2", None, "", None), ("S3", "R1", "", 120)]
    assert rows(R.trips(scan_gtfs_file(spark, drop, "trips"), 7), "trip_id", "direction_id") == [
        ("T1", 0), ("T2", 1)]
    assert rows(R.pathways(scan_gtfs_file(spark, drop, "pathways"), 7), "pathway_mode",
                "traversal_time") == [(8, None)]


def test_missing_file_gives_no_rows(spark, drop):
    assert R.shapes(scan_gtfs_file(spark, drop, "shapes"), 7).count() == 0


def test_source_paths(spark):
    paths = [("a/12/google_transit/stops.txt",), ("12/google_transit/stops.txt/part-0.csv",),
             ("x12/google_transit/stops.txt",), ("12/google_transit.zip",)]
    out = spark.createDataFrame(paths, "p string").select(source_from_path(F.col("p")).alias("s"))
    assert [r.s for r in out.collect()] == [12, 12, None, None]


def test_portal_answers(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"help":"h","success":true,"result":{"id":"r","name":"n","last_modified":"2024-07-01T10:00:00.5",'
        '"format":"ZIP","url":"https://x/y/abc","package_id":"p","datastore_active":false}}\n'
        '{"success":false,"result":null}\n')
    out = portal.scan_dataset_metadata(spark, str(tmp_path)).collect()
    assert len(out) == 1 and out[0].url_resource == "abc"
    assert out[0].last_modified == dt.datetime(2024, 7, 1, 10, 0, 0, 500000)


CLEAN = {
    "1/google_transit/stops.txt": "stop_id,stop_name,stop_lat,stop_lon\nS1,One,-37.8,144.9\n"
                                  "S2,Two,-37.9,144.8\nS3,Three,-37.7,144.7\n",
    "1/google_transit/routes.txt": "route_id,agency_id,route_short_name,route_type\nR1,A1,96,0\n",
    "1/google_transit/pathways.txt":
        "pathway_id,from_stop_id,to_stop_id,pathway_mode,is_bidirectional\nP1,S1,S2,2,0\n",
    "1/google_transit/transfers.txt": "from_stop_id,to_stop_id,from_route_id,transfer_type\nS1,S2,,2\n",
}


@pytest.fixture(scope="module")
def clean(tmp_path_factory):
    root = tmp_path_factory.mktemp("clean")
    for name, text in {**FILES, **CLEAN}.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf8")
    return str(root)


def first_version(spark, warehouse, updated="2023-01-01"):
    first = spark.sql(
        "SELECT 1 AS version_id, 'old' AS version_name, timestamp'2023-01-01' AS created_at, "
        f"timestamp'{updated}' AS updated_at, true AS is_active, cast(null as string) AS source_url, "
        "cast(null as string) AS description")
    sinks.save_versions(first, warehouse, 0)
    return spark.sql("SELECT 'https://x/abc' AS url, timestamp'2024-01-02 03:04:05' AS last_modified")


def test_load_activates_last_and_refreshes_views(spark, clean, tmp_path):
    warehouse = str(tmp_path)
    metadata = first_version(spark, warehouse)
    sources = spark.createDataFrame([(1, "a"), (2, "b")], "source_id int, source_name string")
    load = load_schedule(spark, clean, warehouse, metadata, "2024-01-14 21:00:00", sources)
    assert (load.version_id, load.activated, load.broken) == (2, True, [])
    versions = sinks.load_versions(spark, warehouse)
    assert rows(versions, "version_id", "version_name", "is_active") == [
        (1, "old", False), (2, "gtfs_2024-01-02_03:04:05", True)]
    stored = sinks.read_version_tables(spark, warehouse, ["stop_times"])["stop_times"]
    assert stored.count() == 4
    report = saved_views(spark, warehouse, "2024-01-14 21:00:00")
    assert rows(report, "view_name", "refresh_status") == [
        ("active_services", "SUCCESS"), ("stop_routes", "SUCCESS")]
    # The removal on the 15th wins over the Monday flag.
    assert report.where("duration_seconds > 0").count() == 2
    days = sinks.load_view(spark, f"{warehouse}/views", "active_services")
    assert (dt.date(2024, 1, 15),) not in rows(days, "service_date")
    assert (dt.date(2024, 1, 16),) in rows(days, "service_date")


def test_a_dirty_drop_stays_inactive(spark, drop, tmp_path):
    warehouse = str(tmp_path)
    sources = spark.createDataFrame([(1, "a")], "source_id int, source_name string")
    load = load_schedule(spark, drop, warehouse, first_version(spark, warehouse), "2024-01-14 21:00:00", sources)
    assert (load.version_id, load.activated) == (2, False)
    assert {tuple(r) for r in load.broken} == {
        ("pathways", "pathway_mode", 1), ("transfers", "transfer_type", 1),
        ("agency", "source_id not in transport_sources", 1)}
    assert rows(sinks.load_versions(spark, warehouse), "version_id", "is_active") == [(1, True), (2, False)]


def test_a_stale_or_empty_drop_is_not_taken(spark, clean, tmp_path):
    old, empty = str(tmp_path / "old"), str(tmp_path / "empty")
    metadata = first_version(spark, old, "2024-02-01")
    assert load_schedule(spark, clean, old, metadata, "2024-01-14 21:00:00") == (None, False, [])
    assert rows(sinks.load_versions(spark, old), "version_id") == [(1,)]
    (tmp_path / "nothing").mkdir()
    load = load_schedule(spark, str(tmp_path / "nothing"), empty, first_version(spark, empty),
                         "2024-01-14 21:00:00")
    assert not load.activated
    assert {(r.table_name, r.rule) for r in load.broken} == {
        (t, "no rows") for t in ("agency", "stops", "routes", "trips", "stop_times")}


def test_quality_report(spark, drop):
    report = quality_report(typed_tables(spark, drop, 7))
    bad = {(r.table_name, r.rule): r.violations
           for r in report["check_violations"].where("violations > 0").collect()}
    assert bad == {("pathways", "pathway_mode"): 1, ("transfers", "transfer_type"): 1}
    orphans = {(r.child, r.column_name): r.orphan_rows
               for r in report["fk_orphans"].where("orphan_rows > 0").collect()}
    assert orphans == {("transfers", "from_trip_id"): 2, ("transfers", "to_trip_id"): 2}
    assert report["pk_duplicates"].count() == 0


def test_a_failed_refresh_leaves_the_view_and_a_repeated_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    sinks.refresh_views(spark, root, {"v": lambda: spark.range(3)}, "2024-01-14 21:00:00")
    broken = {"v": lambda: spark.range(5).selectExpr("raise_error('no') AS id")}
    report = sinks.refresh_views(spark, root, broken, "2024-01-14 21:00:00").first()
    assert report.refresh_status.startswith("ERROR") and sinks.load_view(spark, root, "v").count() == 3
    sinks.refresh_views(spark, root, {"v": lambda: spark.range(4)}, "2024-01-14 21:00:00")
    assert sinks.load_view(spark, root, "v").count() == 4
    for _ in range(2):
        sinks.publish_events(spark.range(6), f"{root}/events", batch_id=1)
    assert spark.read.parquet(f"{root}/events").count() == 6
