"""Schedule questions, stops, services and name or place search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalog.derived import SCHEDULE, Tables
from catalog.registry import MORNING, NIGHT, SHARED_SQL, query, ts
from headway.operators import cells, departures as D, search as G, services as V, stops as P
from headway.operators.name_index import index_names, load_name_index, similar_names, write_name_index
from headway.operators.versions import in_scope
from headway.session import shared_dir

ALL = [n for n in SCHEDULE]


def monday() -> Column:
    return F.to_date(F.lit("2024-01-15"))


def schedule(t: Tables) -> dict[str, DataFrame]:
    return t.pick(*ALL)


def active(t: Tables, name: str) -> DataFrame:
    return in_scope(t[name], t["versions"])


def running_sql(date: str, weekday: str) -> str:
    return f"""
(SELECT source_id, version_id, service_id FROM {{calendar}}
 WHERE version_id = 2 AND DATE '{date}' BETWEEN start_date AND end_date AND {weekday} = 1
 UNION
 SELECT source_id, version_id, service_id FROM {{calendar_dates}}
 WHERE version_id = 2 AND date = DATE '{date}' AND exception_type = 1)
EXCEPT
SELECT source_id, version_id, service_id FROM {{calendar_dates}}
WHERE version_id = 2 AND date = DATE '{date}' AND exception_type = 2"""


def due_sql(now: int) -> str:
    """Departures still to come at ``now`` seconds of Monday 2024-01-15."""
    branch = lambda offset, services, condition: f"""
SELECT st.trip_id, t.trip_headsign, t.direction_id, t.route_id, st.stop_id,
       st.departure_time_seconds - {offset} * 86400 AS secs, st.stop_sequence, st.pickup_type,
       st.drop_off_type, st.source_id, st.version_id, {offset} AS day_offset
FROM {{stop_times}} AS st
JOIN {{trips}} AS t ON t.trip_id = st.trip_id AND t.source_id = st.source_id AND t.version_id = st.version_id
JOIN {{routes}} AS r ON r.route_id = t.route_id AND r.source_id = t.source_id AND r.version_id = t.version_id
JOIN {{{services}}} AS a ON a.service_id = t.service_id AND a.source_id = t.source_id
WHERE st.version_id = 2 AND {condition}
  AND EXISTS (SELECT 1 FROM {{stop_times}} AS later
              WHERE later.trip_id = st.trip_id AND later.source_id = st.source_id
                AND later.version_id = st.version_id AND later.stop_sequence > st.stop_sequence)"""
    return (branch(0, "run_monday", f"st.departure_time_seconds >= {now}") + "\nUNION ALL"
            + branch(1, "run_sunday", "st.departure_time_seconds >= 86400 "
                                      f"AND st.departure_time_seconds - 86400 >= {now}"))


CLOCK = ("printf('%02d:%02d:%02d', CAST(secs % 86400 // 3600 AS INT), "
         "CAST(secs % 3600 // 60 AS INT), CAST(secs % 60 AS INT))")

SHARED_SQL.update({
    "run_monday": running_sql("2024-01-15", "monday"),
    "run_sunday": running_sql("2024-01-14", "sunday"),
    "due_morning": due_sql(28800),
    "due_night": due_sql(1800),
    "edges": """
SELECT source_id, version_id, stop_id AS asked, stop_id, stop_name FROM {stops} WHERE version_id = 2
UNION
SELECT source_id, version_id, parent_station, stop_id, stop_name FROM {stops}
WHERE version_id = 2 AND parent_station IS NOT NULL""",
})


def board_sql(due: str) -> str:
    return f"""
SELECT d.trip_id, d.route_id, r.route_short_name, r.route_long_name, r.route_type, r.route_color,
       r.route_text_color, d.trip_headsign, e.asked AS stop_id, e.stop_name,
       d.secs AS scheduled_departure_time_seconds, {CLOCK} AS scheduled_departure_time,
       d.stop_sequence, d.pickup_type, d.drop_off_type, d.source_id, d.version_id,
       CASE WHEN d.source_id = 2 THEN coalesce(p.platform_number, d.stop_id) ELSE d.stop_id END AS platform_id,
       d.direction_id
FROM {{{due}}} AS d
JOIN {{edges}} AS e ON e.stop_id = d.stop_id AND e.source_id = d.source_id
JOIN {{routes}} AS r ON r.route_id = d.route_id AND r.source_id = d.source_id AND r.version_id = d.version_id
LEFT JOIN {{platform_numbers}} AS p ON p.platform_id = d.stop_id"""


def stop_departures_sql(due: str) -> str:
    return (board_sql(due) + "\nWHERE e.asked = 'S5' AND d.source_id = 2"
            "\nORDER BY secs, d.trip_id, d.stop_sequence LIMIT 50")


# ---- services ---------------------------------------------------------------------------


@query("QA_active_services", "SELECT * FROM {run_monday}")
def _(t: Tables) -> DataFrame:
    return V.active_services(active(t, "calendar"), active(t, "calendar_dates"), monday())


SERVICE_ACTIVITY_SQL = """
SELECT k.source_id, k.version_id, k.service_id,
  (EXISTS (SELECT 1 FROM {calendar} AS c WHERE c.source_id = k.source_id AND c.version_id = k.version_id
             AND c.service_id = k.service_id AND DATE '2024-01-15' BETWEEN start_date AND end_date AND monday = 1)
   AND NOT EXISTS (SELECT 1 FROM {calendar_dates} AS d WHERE d.source_id = k.source_id
             AND d.version_id = k.version_id AND d.service_id = k.service_id
             AND d.date = DATE '2024-01-15' AND exception_type = 2))
  OR EXISTS (SELECT 1 FROM {calendar_dates} AS d WHERE d.source_id = k.source_id
             AND d.version_id = k.version_id AND d.service_id = k.service_id
             AND d.date = DATE '2024-01-15' AND exception_type = 1) AS is_active
FROM (SELECT source_id, version_id, service_id FROM {calendar}
      UNION SELECT source_id, version_id, service_id FROM {calendar_dates}) AS k"""


@query("QB_service_activity", SERVICE_ACTIVITY_SQL + " WHERE k.version_id = 2")
def _(t: Tables) -> DataFrame:
    return V.service_activity(active(t, "calendar"), active(t, "calendar_dates"), monday())


@query("QB_is_service_active", "SELECT is_active FROM (" + SERVICE_ACTIVITY_SQL
       + ") AS a WHERE version_id = 2 AND source_id = 1 AND service_id = 'C4'")
def _(t: Tables) -> DataFrame:
    return V.is_service_active(schedule(t), 1, "C4", monday())


@query("QG_mv_active_services", """
WITH days AS (SELECT DATE '2024-01-14' + CAST(i AS INT) AS service_date FROM range(0, 9) AS r(i))
(SELECT service_date, source_id, service_id FROM days, {calendar}
 WHERE version_id = 2 AND service_date BETWEEN start_date AND end_date
   AND CASE isodow(service_date) WHEN 1 THEN monday WHEN 2 THEN tuesday WHEN 3 THEN wednesday
       WHEN 4 THEN thursday WHEN 5 THEN friday WHEN 6 THEN saturday ELSE sunday END = 1
 UNION
 SELECT date, source_id, service_id FROM {calendar_dates}
 WHERE version_id = 2 AND exception_type = 1 AND date IN (SELECT service_date FROM days))
EXCEPT
SELECT date, source_id, service_id FROM {calendar_dates}
WHERE version_id = 2 AND exception_type = 2 AND date IN (SELECT service_date FROM days)""")
def _(t: Tables) -> DataFrame:
    return V.upcoming_services(schedule(t), MORNING)


# ---- departures ---------------------------------------------------------------------------


@query("QC_get_stop_departures", stop_departures_sql("due_morning"))
def flagship(t: Tables) -> DataFrame:
    return D.get_stop_departures(schedule(t), "S5", 2, MORNING)


@query("QC_get_stop_departures_night", stop_departures_sql("due_night"))
def _(t: Tables) -> DataFrame:
    return D.get_stop_departures(schedule(t), "S5", 2, NIGHT)


RANKED = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, stop_id
    ORDER BY scheduled_departure_time_seconds, trip_id, stop_sequence) AS position
  FROM (%s) AS b) AS ranked WHERE position <= %d"""


def _ranked(due: str, k: int) -> str:
    return ("SELECT * REPLACE (CAST(position AS INT) AS position) FROM ("
            + RANKED % (board_sql(due), k) + ") AS r")


@query("QC2_departure_board", _ranked("due_morning", 50))
def _(t: Tables) -> DataFrame:
    return D.departure_board(schedule(t), MORNING, 50)


@query("QC2_departure_board_night", _ranked("due_night", 20))
def _(t: Tables) -> DataFrame:
    return D.departure_board(schedule(t), NIGHT, 20)


def stop_times_sql(low: int, high: int, types: str, limit: int) -> str:
    return f"""
SELECT CAST(arrival_time_seconds AS BIGINT) AS arrival_time_with_offset,
       CAST(departure_time_seconds AS BIGINT) AS departure_time_with_offset, x.trip_id, trip_headsign,
       CAST(NULL AS VARCHAR) AS trip_short_name, stop_headsign, x.route_id, route_short_name,
       route_long_name, route_type, route_color, route_text_color, r.agency_id, agency_name,
       agency_timezone, x.service_id, direction_id, stop_sequence,
       CASE WHEN arrival_time_seconds - 28800 < 0 THEN 'past'
            WHEN arrival_time_seconds - 28800 <= 300 THEN 'imminent' ELSE 'future' END AS relative_position
FROM (SELECT DISTINCT ON (st.arrival_time_seconds, st.trip_id) st.*, t.route_id, t.service_id,
             t.trip_headsign, t.direction_id
      FROM {{stop_times}} AS st
      JOIN {{trips}} AS t USING (trip_id, source_id, version_id)
      JOIN {{run_monday}} AS a USING (service_id, source_id, version_id)
      WHERE st.version_id = 2 AND st.source_id = 2 AND st.stop_id = 'S5'
        AND (st.arrival_time_seconds BETWEEN {low} AND {high}
             OR st.arrival_time_seconds BETWEEN {low} + 86400 AND {high})
      ORDER BY st.arrival_time_seconds, st.trip_id, st.stop_sequence) AS x
JOIN {{routes}} AS r USING (route_id, source_id, version_id)
JOIN {{agency}} AS g USING (agency_id, source_id, version_id)
{types}
ORDER BY arrival_time_seconds, x.trip_id LIMIT {limit}"""


@query("QD_get_scheduled_stop_times", stop_times_sql(0, 172800, "", 100))
def _(t: Tables) -> DataFrame:
    return D.get_scheduled_stop_times(schedule(t), 2, "S5", MORNING)


@query("QD_get_scheduled_stop_times_window",
       stop_times_sql(27000, 64800, "WHERE route_type IN (1, 3)", 40))
def _(t: Tables) -> DataFrame:
    return D.get_scheduled_stop_times(schedule(t), 2, "S5", MORNING, "07:30:00", "18:00:00",
                                      [1, 3], 40)


STOP_ROUTES_SQL = """
SELECT st.source_id, st.stop_id, r.route_id, r.route_short_name, r.route_long_name, r.route_type,
       r.route_color, r.route_text_color, g.agency_id, g.agency_name,
       count(DISTINCT t.trip_id) AS trip_count, count(DISTINCT t.service_id) AS service_count,
       array_to_string(list_sort(array_agg(DISTINCT t.service_id)), ',') AS service_ids
FROM {stop_times} AS st
JOIN {trips} AS t ON t.trip_id = st.trip_id AND t.source_id = st.source_id AND t.version_id = st.version_id
JOIN {routes} AS r ON r.route_id = t.route_id AND r.source_id = t.source_id AND r.version_id = t.version_id
JOIN {agency} AS g ON g.agency_id = r.agency_id AND g.source_id = r.source_id AND g.version_id = r.version_id
WHERE st.version_id = 2
GROUP BY ALL"""


@query("QE_get_stop_routes", "SELECT * EXCLUDE (source_id, stop_id, service_count, service_ids) FROM ("
       + STOP_ROUTES_SQL + ") AS s WHERE source_id = 2 AND stop_id = 'S5'")
def _(t: Tables) -> DataFrame:
    return P.get_stop_routes(schedule(t), 2, "S5")


@query("QF_mv_stop_routes", STOP_ROUTES_SQL)
def _(t: Tables) -> DataFrame:
    return P.stop_routes(schedule(t))


@query("QH_resolve_stop_platforms", """
SELECT stop_id, source_id, stop_name, parent_station FROM {stops}
WHERE version_id = 2 AND (stop_id = 'S5' OR parent_station = 'S5')""")
def _(t: Tables) -> DataFrame:
    return P.resolve_stop_platforms(active(t, "stops"), "S5").select(
        "stop_id", "source_id", "stop_name", "parent_station")


@query("QH_platform_edges",
       "SELECT source_id, version_id, asked AS asked_stop_id, stop_id, stop_name FROM {edges}")
def _(t: Tables) -> DataFrame:
    return P.platform_edges(active(t, "stops"))


@query("QI_platform_label", """
SELECT st.trip_id, st.source_id, st.stop_sequence, st.stop_id,
       CASE WHEN st.source_id = 2 THEN coalesce(p.platform_number, st.stop_id) ELSE st.stop_id END AS platform_id
FROM {stop_times} AS st LEFT JOIN {platform_numbers} AS p ON p.platform_id = st.stop_id
WHERE st.version_id = 2""")
def _(t: Tables) -> DataFrame:
    calls = active(t, "stop_times").select("trip_id", "source_id", "stop_sequence", "stop_id")
    return P.platform_label(calls, t["platform_numbers"])


@query("QJ_last_stop_filter", """
SELECT trip_id, source_id, version_id, stop_id, stop_sequence FROM {stop_times} AS st
WHERE EXISTS (SELECT 1 FROM {stop_times} AS later WHERE later.trip_id = st.trip_id
    AND later.source_id = st.source_id AND later.version_id = st.version_id
    AND later.stop_sequence > st.stop_sequence)""")
def _(t: Tables) -> DataFrame:
    return P.before_last_stop(t["stop_times"]).select(
        "trip_id", "source_id", "version_id", "stop_id", "stop_sequence")


def latest_update_sql(now: str) -> str:
    """The newest update of each call, received in the five days up to ``now``."""
    return f"""
SELECT * FROM (
  SELECT f.source_id, u.trip_id, d.day_offset, s.stop_sequence AS seq,
         CASE WHEN s.stop_sequence < 0 THEN s.stop_id END AS stop,
         s.arrival_delay, s.departure_delay, s.schedule_relationship, f.received_at,
         row_number() OVER (PARTITION BY f.source_id, u.trip_id, d.day_offset,
             s.stop_sequence, CASE WHEN s.stop_sequence < 0 THEN s.stop_id END
             ORDER BY f.received_at DESC, u.trip_update_id DESC, s.stop_id DESC) AS rn
  FROM {{stop_time_updates}} AS s JOIN {{trip_updates}} AS u USING (trip_update_id)
  JOIN {{feed_messages}} AS f USING (feed_message_id)
  JOIN (VALUES (0, DATE '2024-01-15'), (1, DATE '2024-01-14')) AS d(day_offset, service_date)
    ON coalesce(u.start_date, d.service_date) = d.service_date
  WHERE f.received_at > TIMESTAMP '{now}' - INTERVAL 5 DAY
    AND f.received_at <= TIMESTAMP '{now}') AS x WHERE rn = 1"""


def with_delay_sql(when: str) -> str:
    return f"""
SELECT d.trip_id, d.source_id, d.stop_id, d.stop_sequence, d.day_offset,
       d.secs AS scheduled_departure_time_seconds,
       CASE WHEN c.rn = 1 THEN c.arrival_delay ELSE p.arrival_delay END AS arrival_delay,
       CASE WHEN c.rn = 1 THEN c.departure_delay ELSE p.departure_delay END AS departure_delay,
       CASE WHEN c.rn = 1 THEN c.schedule_relationship ELSE p.schedule_relationship END AS update_relationship,
       {ts("CASE WHEN c.rn = 1 THEN c.received_at ELSE p.received_at END")} AS updated_at,
       d.secs + CASE WHEN c.rn = 1 THEN coalesce(c.departure_delay, c.arrival_delay, 0)
                     ELSE coalesce(p.departure_delay, p.arrival_delay, 0) END AS expected_departure_time_seconds
FROM {{due_{when}}} AS d
LEFT JOIN {{latest_update_{when}}} AS c ON c.source_id = d.source_id AND c.trip_id = d.trip_id
  AND c.day_offset = d.day_offset AND c.seq = d.stop_sequence
LEFT JOIN {{latest_update_{when}}} AS p ON p.source_id = d.source_id AND p.trip_id = d.trip_id
  AND p.day_offset = d.day_offset AND p.stop = d.stop_id"""


def with_delay(t: Tables, now: str) -> DataFrame:
    updates = D.latest_stop_updates(t["stop_time_updates"], t["trip_updates"], t["feed_messages"],
                                    now, "5 days")
    return (D.departures_with_delay(D.scheduled_departures(schedule(t), now), updates)
            .select("trip_id", "source_id", "stop_id", "stop_sequence", "day_offset",
                    "scheduled_departure_time_seconds", *D.UPDATE,
                    "expected_departure_time_seconds"))


SHARED_SQL["latest_update_morning"] = latest_update_sql(MORNING)
SHARED_SQL["latest_update_night"] = latest_update_sql(NIGHT)


@query("T3_departures_with_delay", with_delay_sql("morning"))
def _(t: Tables) -> DataFrame:
    return with_delay(t, MORNING)


@query("T3_departures_with_delay_night", with_delay_sql("night"))
def _(t: Tables) -> DataFrame:
    return with_delay(t, NIGHT)


# ---- search -------------------------------------------------------------------------------


def distance_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"2 * 6378168.0 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


@query("G1_nearby_stops", f"""
SELECT stop_id, source_id, stop_name, round(d, 2) AS distance_m FROM (
  SELECT *, {distance_sql("-37.8183e0", "144.9671e0", "stop_lat", "stop_lon")} AS d
  FROM {{stops}} WHERE version_id = 2) AS s WHERE d <= 30000""")
def _(t: Tables) -> DataFrame:
    return (G.nearby_stops(active(t, "stops"), -37.8183, 144.9671, 30000)
            .select("stop_id", "source_id", "stop_name", F.round("distance_m", 2).alias("distance_m")))


def stored_places(t: Tables) -> DataFrame:
    path = f"{shared_dir(t.spark, 'places')}/places"
    cells.write_places(active(t, "stops"), path)
    return cells.load_places(t.spark, path)


@query("G1_places_in_circle", f"""
SELECT stop_id, source_id, stop_name, round(d, 2) AS distance_m FROM (
  SELECT *, {distance_sql("-37.6183e0", "144.9671e0", "stop_lat", "stop_lon")} AS d
  FROM {{stops}} WHERE version_id = 2) AS s WHERE d <= 9000""")
def _(t: Tables) -> DataFrame:
    return (cells.places_in_circle(stored_places(t), -37.6183, 144.9671, 9000)
            .select("stop_id", "source_id", "stop_name", F.round("distance_m", 2).alias("distance_m")))


@query("G1_nearest_places", f"""
SELECT stop_id, source_id, round(d, 2) AS distance_m FROM (
  SELECT *, {distance_sql("-37.6183e0", "144.9671e0", "stop_lat", "stop_lon")} AS d
  FROM {{stops}} WHERE version_id = 2 AND source_id = 1) AS s ORDER BY d, stop_id LIMIT 25""")
def _(t: Tables) -> DataFrame:
    places = stored_places(t).where("source_id = 1")
    return (cells.nearest_places(places, -37.6183, 144.9671, 25)
            .select("stop_id", "source_id", F.round("distance_m", 2).alias("distance_m")))


@query("G1_vehicles_near_stops", f"""
SELECT vehicle_position_id, min_by(stop_id, (round(d, 6), stop_id)) AS nearest_stop_id,
       round(min(d), 2) AS distance_m, count(*) AS stops_near
FROM (SELECT v.vehicle_position_id, s.stop_id,
             {distance_sql("v.latitude", "v.longitude", "s.stop_lat", "s.stop_lon")} AS d
      FROM {{vehicle_positions}} AS v JOIN {{feed_messages}} AS f USING (feed_message_id)
      JOIN {{stops}} AS s ON s.source_id = f.source_id AND s.version_id = 2) AS pairs
WHERE d <= 5000 GROUP BY vehicle_position_id""")
def _(t: Tables) -> DataFrame:
    feeds = t["feed_messages"].select("feed_message_id", "source_id")
    positions = t["vehicle_positions"].join(feeds, "feed_message_id")
    near = G.vehicles_near_stops(positions, active(t, "stops"), 5000, ["vehicle_position_id"])
    return near.withColumn("distance_m", F.round("distance_m", 2))


@query("G2_search_name_lower", """
SELECT stop_id, source_id, version_id, stop_name FROM {stops}
WHERE starts_with(lower(stop_name), lower('SUPPLIER#00000000'))
UNION ALL
SELECT route_id, source_id, version_id, route_long_name FROM {routes}
WHERE lower(route_long_name) = lower('Nation_7')""")
def _(t: Tables) -> DataFrame:
    stops = G.search_name_lower(t["stops"], "stop_name", "SUPPLIER#00000000", prefix=True)
    routes = G.search_name_lower(t["routes"], "route_long_name", "Nation_7")
    return stops.select("stop_id", "source_id", "version_id", "stop_name").union(
        routes.select("route_id", "source_id", "version_id", "route_long_name"))


def trigrams_sql(text: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    return (f"list_distinct(flatten(list_transform({words}, lambda w: list_transform("
            f"range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))")


TRIGRAM_SHARE = (f"len(list_intersect({trigrams_sql('c_name')}, {trigrams_sql(repr('customer#00042'))}))"
                 f" / len(list_distinct(list_concat({trigrams_sql('c_name')}, {trigrams_sql(repr('customer#00042'))})))")


@query("G3_search_name_trigram", "SELECT c_custkey, c_name, round(s, 6) AS similarity FROM "
       f"(SELECT c_custkey, c_name, CAST({TRIGRAM_SHARE} AS DOUBLE) AS s FROM customer) AS x WHERE s >= 0.5")
def _(t: Tables) -> DataFrame:
    names = t["customer"].select("c_custkey", "c_name")
    return (G.search_name_trigram(names, "c_name", "customer#00042", 0.5)
            .withColumn("similarity", F.round("similarity", 6)))


@query("G3_similar_names", f"""
WITH n AS (SELECT c_custkey, unnest({trigrams_sql("place_name")}) AS piece FROM {{place_names}}),
t AS (SELECT text_id, unnest({trigrams_sql("wanted")}) AS piece FROM {{misspelt}}),
both_sizes AS (
  SELECT text_id, c_custkey, count(*) AS c FROM t JOIN n USING (piece) GROUP BY ALL)
SELECT text_id, c_custkey, round(c / (a + b - c), 6) AS similarity FROM both_sizes
JOIN (SELECT text_id, count(*) AS a FROM t GROUP BY ALL) AS x USING (text_id)
JOIN (SELECT c_custkey, count(*) AS b FROM n GROUP BY ALL) AS y USING (c_custkey)
WHERE c / (a + b - c) >= 0.6""")
def _(t: Tables) -> DataFrame:
    root = shared_dir(t.spark, "names")
    write_name_index(index_names(t["place_names"], "place_name"), root)
    index = load_name_index(t.spark, root)
    found = similar_names(index, t["misspelt"], "wanted", 0.6)
    return found.select("text_id", "c_custkey", F.round("similarity", 6).alias("similarity"))


@query("G4_search_name_tokens", """
SELECT route_id, source_id, version_id, route_short_name, route_long_name FROM {routes}
WHERE list_has_all(regexp_split_to_array(lower(concat_ws(' ', route_short_name, route_long_name)), '[^a-z0-9]+'),
                   ['nation', '3'])
UNION ALL
SELECT stop_id, source_id, version_id, NULL, stop_name FROM {stops}
WHERE list_has_all(regexp_split_to_array(lower(stop_name), '[^a-z0-9]+'), ['supplier', '000000007'])""")
def _(t: Tables) -> DataFrame:
    routes = G.search_name_tokens(t["routes"], ["route_short_name", "route_long_name"], "Nation 3")
    stops = G.search_name_tokens(t["stops"], ["stop_name"], "000000007 SUPPLIER")
    none = F.lit(None).cast("string")
    return (routes.select("route_id", "source_id", "version_id", "route_short_name", "route_long_name")
            .union(stops.select("stop_id", "source_id", "version_id", none, "stop_name")))


@query("G5_unaccent", """
SELECT doc_id, lang FROM documents WHERE contains(lower(strip_accents(text)), 'etion')""")
def _(t: Tables) -> DataFrame:
    return G.search_name_unaccented(t["documents"], "text", "étion").select("doc_id", "lang")
