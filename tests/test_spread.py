"""Work is spread over tasks, done once, and large rows stay where they are."""

from __future__ import annotations

from headway.operators import search as G, services as V, stops as P
from headway.sources.gtfs_files import scan_gtfs_file


def test_lines_of_files_with_spanning_cells_are_not_moved(spark, tmp_path, physical):
    folder = tmp_path / "3" / "google_transit"
    folder.mkdir(parents=True)
    (folder / "stops.txt").write_text('stop_id,stop_name\n1,"a\nb"\n2,c\n')
    found = scan_gtfs_file(spark, str(tmp_path), "stops", sources=[3])
    assert "REPARTITION_BY_COL" not in physical(found)
    assert sorted((r["stop_id"], r["stop_name"]) for r in found.collect()) == [("1", "a\nb"), ("2", "c")]


def test_names_are_spread_and_taken_apart_once(spark, physical):
    names = spark.createDataFrame([(1, "Flinders"), (2, "Flinder"), (3, None), (4, "Other")], "id int, name string")
    found = G.search_name_trigram(names, "name", "flinders", 0.5)
    plan = physical(found).split("== Physical Plan ==")[1]
    assert plan.count("regexp_extract_all") == 1 and "REPARTITION_BY_COL" in plan
    assert [r["id"] for r in found.collect()] == [1, 2]
    assert G.search_name_trigram(names, "name", "flinders", 0.0).count() == 4


def test_calendar_rows_are_spread_before_they_unfold(spark, physical):
    days = ", ".join(f"1 AS {d}" for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"))
    tables = {
        "versions": spark.sql("SELECT 2 AS version_id, true AS is_active"),
        "calendar": spark.sql(f"SELECT 1 AS source_id, 2 AS version_id, 'C' || id % 20 AS service_id, {days}, "
                              "DATE '2024-01-01' AS start_date, DATE '2024-01-31' AS end_date FROM range(40)"),
        "calendar_dates": spark.sql("SELECT 1 AS source_id, 2 AS version_id, 'C1' AS service_id, "
                                    "DATE '2024-01-16' AS date, 2 AS exception_type")}
    found = V.upcoming_services(tables, "2024-01-14 21:00:00")
    assert "REPARTITION_BY_COL" in physical(found)
    assert found.count() == 20 * 9 - 1


def test_calls_are_dealt_over_tasks_by_their_number(spark, monkeypatch, physical):
    monkeypatch.setattr(P, "CALLS_PER_TASK", 7)
    scope = "1 AS source_id, 2 AS version_id"
    tables = {
        "versions": spark.sql("SELECT 2 AS version_id, true AS is_active"),
        "agency": spark.sql(f"SELECT {scope}, 'A' AS agency_id, 'Trams' AS agency_name"),
        "routes": spark.sql(f"SELECT {scope}, 'R' AS route_id, 'A' AS agency_id, '1' AS route_short_name, "
                            "'One' AS route_long_name, 0 AS route_type, 'FF' AS route_color, '00' AS route_text_color"),
        "trips": spark.sql(f"SELECT {scope}, 'T' || id AS trip_id, 'R' AS route_id, 'C' || id % 2 AS service_id "
                           "FROM range(40)"),
        # every trip calls twice at S0 and once at S1 or S2
        "stop_times": spark.sql(f"SELECT {scope}, 'T' || id AS trip_id, stop_id FROM range(40) "
                                "LATERAL VIEW explode(array('S0', 'S0', 'S' || (1 + id % 2))) AS stop_id")}
    found = P.stop_routes(tables)
    assert physical(found).count("REPARTITION_BY_NUM") >= 2
    counts = {r["stop_id"]: (r["trip_count"], r["service_count"], r["service_ids"]) for r in found.collect()}
    assert counts == {"S0": (40, 2, ["C0", "C1"]), "S1": (20, 1, ["C0"]), "S2": (20, 1, ["C1"])}
    assert f", {-(-120 // 7)}), REPARTITION_BY_NUM" in physical(found)
