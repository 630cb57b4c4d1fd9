"""Realtime rows, trip lookups, change events, retention, monitoring and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from catalog import messages as M
from catalog.derived import Tables
from catalog.registry import RETENTION, SHARED_SQL, SQL, iso, query, ts
from headway.operators import (
    events as N, live_trips as L, monitoring as O, quality as Q, realtime_rows as R, retention as D)
from headway.plans import folding, upkeep
from headway.plans.feed_load import load_messages
from headway.schemas import MAX_LENGTH, NOT_NULL, REALTIME_TABLES
from headway.session import shared_dir
from headway.sources import feeds, lookups, sinks
from headway.streaming import jobs

# ---- the nested messages, flat, for the check engine ----------------------------------------

SHARED_SQL.update({
    "fetches": """
SELECT feed_message_id AS m, min(ts) AS first_ts, max(ts) AS received_at, kind, half,
       feed_message_id % 700 = 40 AS failed, feed_message_id % 900 = 20 AS unknown,
       CASE WHEN half = 0 THEN 3 ELSE 2 END AS source_id,
       CASE kind WHEN 0 THEN 'vehicle_positions' WHEN 1 THEN 'trip_updates' ELSE 'service_alerts' END AS feed_type
FROM {fx_ev} GROUP BY feed_message_id, kind, half""",
    "tagged": """
SELECT *, concat_ws(':', CAST(source_id AS VARCHAR), feed_type, CAST(epoch_us(received_at) AS VARCHAR)) AS fk,
       CASE WHEN m % 100 = 0 THEN received_at ELSE date_trunc('second', first_ts) END AS feed_time
FROM {fetches} WHERE NOT failed AND NOT unknown""",
    "entities": """
SELECT e.event_id AS e, e.user_id AS u, e.event_type, date_trunc('second', e.ts) AS ets, t.*,
       'E' || e.event_id AS entity_id, t.fk || ':E' || e.event_id AS eid, e.event_id % 50 = 0 AS is_deleted
FROM {fx_ev} AS e JOIN {tagged} AS t ON t.m = e.feed_message_id WHERE e.event_id % 29 <> 0""",
})

TRIP_ID, ROUTE_ID = "'T' || (e * 13 % 1000)", "'R' || (u % 25)"
START = "CAST(e % 28 * 3600 + 309 AS INT)"
START_DATE = "CASE WHEN e % 37 = 0 THEN NULL ELSE DATE '2024-01-15' END"
RELATIONSHIP = "CASE WHEN e % 4 <> 0 THEN CAST(e % 4 AS INT) END"


def rounded(x: str) -> str:
    return f"CAST(CAST(CAST(CAST({x} AS FLOAT) AS DOUBLE) AS DECIMAL(10,7)) AS DOUBLE)"


def on_trip(x: str) -> str:
    return f"CASE WHEN e % 7 <> 0 THEN {x} END"


FLAT = {
    "feed_messages": """
SELECT fk AS feed_message_id, feed_time AS timestamp, '2.0' AS gtfs_realtime_version,
       CASE WHEN m % 60 = 0 THEN 1 ELSE 0 END AS incrementality, received_at, source_id, 2 AS version_id, feed_type
FROM {tagged}""",
    "vehicle_positions": f"""
SELECT eid AS vehicle_position_id, fk AS feed_message_id, entity_id, is_deleted,
       {on_trip(TRIP_ID)} AS trip_id, {on_trip(ROUTE_ID)} AS route_id, {on_trip(START)} AS start_time,
       {on_trip(START_DATE)} AS start_date, {on_trip(RELATIONSHIP)} AS schedule_relationship,
       CASE WHEN u % 10 <> 0 THEN 'V' || u END AS vehicle_id, CAST(NULL AS VARCHAR) AS vehicle_label,
       CASE WHEN u % 10 <> 0 THEN 'ABC' END AS license_plate,
       {rounded("-38e0 + CAST(e * 37 % 100 AS DOUBLE) / 100")} AS latitude,
       {rounded("144.5e0 + CAST(e * 53 % 100 AS DOUBLE) / 100")} AS longitude,
       CAST(e % 360 AS DOUBLE) AS bearing, CAST(e % 3 AS INT) AS current_status,
       CASE WHEN event_type <> 'view' THEN 'S' || (u % 10) END AS stop_id,
       CASE WHEN e % 31 = 0 THEN received_at ELSE ets END AS timestamp
FROM {{entities}} WHERE kind = 0 AND e % 23 <> 0""",
    "trip_updates": f"""
SELECT eid AS trip_update_id, fk AS feed_message_id, entity_id, is_deleted, {TRIP_ID} AS trip_id,
       {ROUTE_ID} AS route_id, CAST(e % 2 AS INT) AS direction_id, {START} AS start_time,
       {START_DATE} AS start_date, {RELATIONSHIP} AS schedule_relationship, 'V' || u AS vehicle_id,
       'Tram' AS vehicle_label, CASE WHEN e % 17 <> 0 THEN ets END AS timestamp,
       CAST(e * 31 % 900 - 120 AS INT) AS delay
FROM {{entities}} WHERE kind = 1 AND e % 19 <> 0""",
    "stop_time_updates": """
SELECT eid AS trip_update_id, CASE WHEN e % 8 <> 0 THEN n ELSE -1 END AS stop_sequence,
       CASE WHEN e % 11 <> 0 THEN 'S' || ((e + n) % 10) ELSE '' END AS stop_id,
       CASE WHEN e % 6 <> 0 THEN CAST(e * 31 % 900 - 120 + n AS INT) END AS arrival_delay,
       CASE WHEN e % 6 <> 0 THEN e * 60 + 1704067200 END AS arrival_time,
       CASE WHEN e % 6 <> 0 THEN 30 END AS arrival_uncertainty,
       CASE WHEN e % 9 <> 0 THEN CAST(e * 31 % 900 - 90 AS INT) END AS departure_delay,
       CASE WHEN e % 9 <> 0 THEN e * 60 + 1704067260 END AS departure_time,
       CASE WHEN e % 9 <> 0 THEN 30 END AS departure_uncertainty, 0 AS schedule_relationship
FROM (SELECT *, {twice} AS n FROM {entities} WHERE kind = 1 AND e % 19 <> 0) AS s WHERE n <= e % 3""",
    "alerts": """
SELECT eid AS alert_id, fk AS feed_message_id, entity_id, is_deleted, CAST(e % 12 + 1 AS INT) AS cause,
       CAST(e % 11 + 1 AS INT) AS effect, CASE WHEN e % 13 <> 0 THEN CAST(e % 4 + 1 AS INT) END AS severity
FROM {entities} WHERE kind = 2""",
    "alert_active_periods": """
SELECT eid AS alert_id, e * 7919 % 864000 + 1704067200 AS start_time,
       CASE WHEN (e + n) % 5 <> 0 THEN (e * 7919 + n * 400000) % 2592000 + 1704067200 END AS end_time
FROM (SELECT *, {twice} AS n FROM {entities} WHERE kind = 2) AS p WHERE n <= e % 3""",
    "alert_informed_entities": f"""
SELECT eid AS alert_id, 'A' || (e % 5) AS agency_id, CASE WHEN n <> 3 THEN 'R' || (e % 25) END AS route_id,
       CAST(e % 2 AS INT) AS direction_id, CASE WHEN n = 2 THEN {TRIP_ID} END AS trip_id,
       CASE WHEN n = 2 THEN {ROUTE_ID} END AS trip_route_id, CASE WHEN n = 2 THEN {START} END AS trip_start_time,
       CASE WHEN n = 2 THEN {START_DATE} END AS trip_start_date, CASE WHEN n <> 1 THEN 'S' || (e % 10) END AS stop_id
FROM (SELECT *, {{thrice}} AS n FROM {{entities}} WHERE kind = 2) AS i""",
    "alert_translations": """
SELECT eid AS alert_id, 'url' AS field_type, '' AS language, 'https://news.example/' || e AS text
FROM {entities} WHERE kind = 2 AND e % 2 = 0
UNION ALL SELECT eid, 'header_text', 'en', 'Works on route ' || (e % 25) FROM {entities} WHERE kind = 2""",
}
SHARED_SQL.update({f"flat_{n}": sql for n, sql in FLAT.items()})

# What an ingest job keeps of them: no message of which a trip update names a stop twice.
REPEATED_STOP = """kind = 1 AND event_id % 29 <> 0 AND event_id % 19 <> 0 AND event_id % 3 = 2 AND event_id % 88 = 0"""
SHARED_SQL["repeating"] = """
SELECT DISTINCT regexp_replace(trip_update_id, ':E[0-9]+$', '') AS fk FROM {flat_stop_time_updates}
GROUP BY trip_update_id, stop_sequence, stop_id HAVING count(*) > 1"""
PARENT_ID = {"stop_time_updates": "trip_update_id", "alert_active_periods": "alert_id",
             "alert_informed_entities": "alert_id", "alert_translations": "alert_id"}
SHARED_SQL.update({
    f"stored_{n}": f"SELECT * FROM {{flat_{n}}} WHERE " + (
        f"regexp_replace({PARENT_ID[n]}, ':E[0-9]+$', '')" if n in PARENT_ID else "feed_message_id")
    + " NOT IN (SELECT fk FROM {repeating})" for n in FLAT})
STAMPS = {"feed_messages": ["timestamp", "received_at"], "vehicle_positions": ["timestamp"],
          "trip_updates": ["timestamp"]}


def shown(name: str, prefix: str = "flat_") -> str:
    stamps = ", ".join(f"{ts(c)} AS {c}" for c in STAMPS.get(name, []))
    return f"SELECT *{f' REPLACE ({stamps})' if stamps else ''} FROM {{{prefix}{name}}}"


def tagged(t: Tables) -> DataFrame:
    messages = M.feed_messages(t).where("error is null and message is not null")
    return feeds.tag_messages(messages, endpoints(t), t["versions"])


def endpoints(t: Tables) -> DataFrame:
    return feeds.endpoints_dim(t.spark, lookups.transport_sources(t.spark))


ROW_IDS = {"R1_feed_messages": "feed_messages", "R2_vehicle_positions": "vehicle_positions",
           "R3_trip_updates": "trip_updates", "R4_stop_time_updates": "stop_time_updates",
           "R6_alerts": "alerts", "R7_alert_active_periods": "alert_active_periods",
           "R8_alert_informed_entities": "alert_informed_entities",
           "R9_alert_translations": "alert_translations"}

for row_id, table in ROW_IDS.items():
    query(row_id, shown(table))(lambda t, name=table: R.REALTIME_ROWS[name](tagged(t)))


@query("R5_affected_stops", """
SELECT DISTINCT fk AS feed_message_id, 'S' || ((e + n) % 10) AS stop_id
FROM (SELECT *, {twice} AS n FROM {entities} WHERE kind = 1 AND e % 19 <> 0) AS s
WHERE n <= e % 3 AND e % 11 <> 0""")
def _(t: Tables) -> DataFrame:
    return R.affected_stops(tagged(t))


@query("R10_parent_keys", """
SELECT feed_message_id, entity_id, trip_update_id AS parent_id FROM {flat_trip_updates}
UNION ALL SELECT feed_message_id, entity_id, alert_id FROM {flat_alerts}""")
def _(t: Tables) -> DataFrame:
    return R.parent_keys(tagged(t))


@query("R11_active_version_tag", """
SELECT fk AS feed_message_id, source_id, feed_type, (SELECT version_id FROM {versions} WHERE is_active) AS version_id
FROM {tagged}""")
def _(t: Tables) -> DataFrame:
    return tagged(t).select("feed_message_id", "source_id", "feed_type", "version_id")


@query("S4_scan_feed_messages", """
SELECT CASE WHEN unknown THEN 'elsewhere' ELSE CASE WHEN half = 0 THEN 'tram_' ELSE 'metrotrain_' END || feed_type END AS endpoint,
       %s AS received_at, CASE WHEN m %% 100 <> 0 THEN CAST(floor(epoch(first_ts)) AS BIGINT) END AS header_time,
       CAST((SELECT count(*) FROM {fx_ev} AS e WHERE e.feed_message_id = m) AS INT) AS entities
FROM {fetches} WHERE NOT failed""" % ts("received_at"))
def _(t: Tables) -> DataFrame:
    return stored_messages(t).select(
        "endpoint", "received_at", F.col("message.header.timestamp").alias("header_time"),
        F.size("message.entity").alias("entities"))


def message_files(t: Tables) -> str:
    path = shared_dir(t.spark, "messages")
    (M.feed_messages(t).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path))
    return path


def stored_messages(t: Tables) -> DataFrame:
    return feeds.scan_feed_messages(t.spark, message_files(t))


def usual_messages(t: Tables, feed_type: str | None) -> DataFrame:
    """The stored messages once more, written as feeds usually write JSON; all are written, those
    of the endpoints of ``feed_type`` are read where a table holds rows of no other."""
    path = shared_dir(t.spark, "usual")
    M.usual_lines(t).write.text(path)
    named = feeds.endpoints_of(feed_type) if feed_type else None
    return feeds.tag_messages(feeds.scan_feed_messages(t.spark, path, endpoints=named), endpoints(t), t["versions"])


for table, feed_type in (("feed_messages", None), ("vehicle_positions", "vehicle_positions"),
                         ("trip_updates", "trip_updates"), ("stop_time_updates", "trip_updates"),
                         ("alerts", "service_alerts"), ("alert_active_periods", "service_alerts"),
                         ("alert_informed_entities", "service_alerts")):
    query(f"S4_usual_json_{table}", shown(table))(
        lambda t, name=table, kind=feed_type: R.REALTIME_ROWS[name](usual_messages(t, kind)))


@query("S5_endpoints_dim", """
SELECT CASE WHEN half = 0 THEN 'tram_' ELSE 'metrotrain_' END || feed_type AS endpoint, source_id,
       count(*) AS messages FROM {fetches} WHERE NOT failed AND NOT unknown GROUP BY ALL
UNION ALL SELECT 'elsewhere', NULL, count(*) FROM {fetches} WHERE NOT failed AND unknown""")
def _(t: Tables) -> DataFrame:
    usable = M.feed_messages(t).where("error is null and message is not null")
    known = (usable.join(endpoints(t), "endpoint").groupBy("endpoint", "source_id")
             .agg(F.count(F.lit(1)).alias("messages")))
    unknown = (feeds.unknown_endpoints(usable, endpoints(t))
               .groupBy("endpoint").agg(F.count(F.lit(1)).alias("messages")))
    return known.unionByName(unknown.withColumn("source_id", F.lit(None).cast("int")))


# ---- trips -------------------------------------------------------------------------------------


def live_clock(t: Tables) -> Column:
    """Ten minutes after the last trip update message."""
    newest = t["feed_messages"].where("feed_type = 'trip_updates'").agg(F.max("received_at"))
    return newest.scalar() + F.expr("INTERVAL 10 MINUTES")


NOW = ("(SELECT max(received_at) + INTERVAL 10 MINUTE FROM {feed_messages} WHERE feed_type = 'trip_updates')")
LIVE = ["feed_messages", "vehicle_positions", "trip_updates", "stop_time_updates", "alerts",
        "alert_active_periods", "alert_informed_entities"]


@query("T1_get_trip_realtime_data", f"""
SELECT u.trip_id, u.route_id, s.stop_id, s.departure_delay, s.arrival_delay, s.schedule_relationship,
       {ts("f.received_at")} AS received_at
FROM {{trip_updates}} AS u JOIN {{feed_messages}} AS f USING (feed_message_id)
LEFT JOIN {{stop_time_updates}} AS s USING (trip_update_id)
WHERE u.trip_id IN (SELECT trip_id FROM {{trips}}) AND f.received_at > {NOW} - INTERVAL 30 MINUTE""")
def _(t: Tables) -> DataFrame:
    return L.get_trip_realtime_data(t.pick(*LIVE), t["trips"], live_clock(t))


SHARED_SQL["trip_groups"] = f"""
SELECT * FROM (
  SELECT u.trip_id, u.route_id, f.source_id, list_sort(array_agg(DISTINCT s.stop_id), 'ASC', 'NULLS LAST') AS stops,
         count(*) AS update_count,
         row_number() OVER (PARTITION BY u.trip_id ORDER BY u.route_id NULLS LAST, f.source_id) AS rn
  FROM {{trip_updates}} AS u JOIN {{feed_messages}} AS f USING (feed_message_id)
  LEFT JOIN {{stop_time_updates}} AS s USING (trip_update_id)
  WHERE f.received_at > {NOW} - INTERVAL 1 HOUR GROUP BY u.trip_id, u.route_id, f.source_id) AS g WHERE rn = 1"""


@query("T2_trip_update_batch", """
SELECT trip_id, route_id, source_id,
       array_to_string(list_transform(stops, lambda x: coalesce(x, '-')), ',') AS stop_ids, update_count
FROM {trip_groups}""")
def _(t: Tables) -> DataFrame:
    return L.trip_update_batch(t.pick(*LIVE), None, live_clock(t))


# ---- change events -------------------------------------------------------------------------------

UPDATES = """{stop_time_updates} AS s JOIN {trip_updates} AS u USING (trip_update_id)
JOIN {feed_messages} AS f USING (feed_message_id)"""
POSITIONS = "{vehicle_positions} AS v JOIN {feed_messages} AS f USING (feed_message_id)"
ALERTS = "{alerts} AS a JOIN {feed_messages} AS f USING (feed_message_id)"
AT = ts("f.timestamp") + " AS event_time"
STAMP = "'timestamp', " + iso("f.timestamp")


def stop_updates(t: Tables) -> DataFrame:
    return N.with_trip_update(t["stop_time_updates"], t["trip_updates"], t["feed_messages"])


def positions(t: Tables) -> DataFrame:
    return N.with_feed(t["vehicle_positions"], t["feed_messages"])


def alerts(t: Tables) -> DataFrame:
    return N.with_feed(t["alerts"], t["feed_messages"])


N1 = f"""
SELECT 'stop_departures:' || f.source_id || ':' || s.stop_id AS channel,
       json_object('type', 'update', 'source_id', f.source_id, 'stop_id', s.stop_id, 'trip_id', u.trip_id,
         'route_id', u.route_id, 'arrival_delay', s.arrival_delay, 'departure_delay', s.departure_delay,
         'arrival_time', s.arrival_time, 'departure_time', s.departure_time,
         'schedule_relationship', s.schedule_relationship, {STAMP}, 'operation', 'INSERT') AS payload, {AT}
FROM {UPDATES}"""


@query("N1_stop_departures", N1)
def _(t: Tables) -> DataFrame:
    return N.stop_departure_events(stop_updates(t))


@query("N2_vehicle_positions", f"""
SELECT 'vehicle_positions:' || f.source_id || ':' || v.vehicle_id AS channel,
       json_object('type', 'vehicle_position', 'entity_id', v.entity_id, 'trip_id', v.trip_id, 'route_id', v.route_id,
         'source_id', f.source_id, 'version_id', f.version_id, 'operation', 'INSERT', {STAMP},
         'vehicle_id', v.vehicle_id, 'vehicle_label', v.vehicle_label, 'latitude', v.latitude,
         'longitude', v.longitude, 'bearing', v.bearing, 'current_status', v.current_status,
         'stop_id', v.stop_id, 'schedule_relationship', v.schedule_relationship) AS payload, {AT}
FROM {POSITIONS} WHERE v.vehicle_id IS NOT NULL""")
def _(t: Tables) -> DataFrame:
    return N.vehicle_position_events(positions(t))


@query("N3_vehicle_at_stop", f"""
SELECT 'vehicle_at_stop:' || f.source_id || ':' || v.stop_id AS channel,
       json_object('type', 'vehicle_at_stop', 'stop_id', v.stop_id, 'vehicle_id', v.vehicle_id, 'trip_id', v.trip_id,
         'route_id', v.route_id, 'current_status', v.current_status, {STAMP}) AS payload, {AT}
FROM {POSITIONS} WHERE v.stop_id IS NOT NULL""")
def _(t: Tables) -> DataFrame:
    return N.vehicle_at_stop_events(positions(t))


@query("N4_service_alerts_update", f"""
SELECT 'service_alerts_update' AS channel,
       json_object('type', 'service_alert', 'alert_id', a.alert_id, 'entity_id', a.entity_id, 'source_id', f.source_id,
         'version_id', f.version_id, 'operation', 'INSERT', {STAMP}, 'cause', a.cause, 'effect', a.effect,
         'severity', a.severity) AS payload, {AT}
FROM {ALERTS}""")
def _(t: Tables) -> DataFrame:
    return N.alert_events(alerts(t))


def selector_sql(what: str, prefix: str) -> str:
    return f"""
SELECT '{prefix}:' || f.source_id || ':' || i.{what} AS channel,
       json_object('type', 'service_alert', 'alert_id', a.alert_id, '{what}', i.{what}, 'cause', a.cause,
         'effect', a.effect, 'severity', a.severity, {STAMP}) AS payload, {AT}
FROM {ALERTS}
JOIN (SELECT DISTINCT alert_id, route_id, stop_id, agency_id FROM {{alert_informed_entities}}) AS i USING (alert_id)
WHERE i.{what} IS NOT NULL"""


@query("N5_service_alerts_route", selector_sql("route_id", "service_alerts_route"))
def _(t: Tables) -> DataFrame:
    return N.alert_route_events(N.with_alert(t["alert_informed_entities"], alerts(t)))


@query("N6_service_alerts_stop", selector_sql("stop_id", "service_alerts_stop"))
def _(t: Tables) -> DataFrame:
    return N.alert_stop_events(N.with_alert(t["alert_informed_entities"], alerts(t)))


@query("N7_feed_messages", f"""
SELECT 'feed_messages:' || f.source_id AS channel,
       json_object('type', 'feed_update', 'feed_message_id', f.feed_message_id, 'source_id', f.source_id,
         'version_id', f.version_id, 'feed_type', f.feed_type, 'operation', 'INSERT', {STAMP},
         'received_at', {iso("f.received_at")}, 'gtfs_realtime_version', f.gtfs_realtime_version,
         'incrementality', f.incrementality) AS payload, {AT}
FROM {{feed_messages}} AS f""")
def _(t: Tables) -> DataFrame:
    return N.feed_message_events(t["feed_messages"])




def with_epoch(fields: str, operation: str) -> str:
    """JSON text ending in an operation and a plain decimal epoch."""
    return (f"left(json_object({fields}, 'operation', '{operation}'), -1) || ',\"timestamp\":' || "
            f"printf('%.6f', epoch_us({NOW}) / 1e6) || '}}'")


@query("N8_trip_updates", f"""
SELECT 'trip_updates:' || u.trip_id AS channel,
       {with_epoch("'trip_id', u.trip_id, 'route_id', u.route_id, 'source_id', f.source_id, 'stop_id', s.stop_id, "
                   "'departure_delay', s.departure_delay, 'arrival_delay', s.arrival_delay, "
                   "'schedule_relationship', s.schedule_relationship", "INSERT")} AS payload,
       {ts(NOW)} AS event_time
FROM {UPDATES}""")
def _(t: Tables) -> DataFrame:
    return N.trip_events(stop_updates(t), live_clock(t))


@query("N9_trip_batch_update", f"""
SELECT 'trip_updates:' || trip_id AS channel,
       {with_epoch("'trip_id', trip_id, 'route_id', route_id, 'source_id', source_id, 'stop_ids', stops, "
                   "'update_count', update_count", "BATCH_UPDATE")} AS payload,
       {ts(NOW)} AS event_time
FROM {{trip_groups}}""")
def _(t: Tables) -> DataFrame:
    return N.trip_batch_events(L.trip_update_batch(t.pick(*LIVE), None, live_clock(t)), live_clock(t))


# ---- sinks ---------------------------------------------------------------------------------------


def sums_sql(name: str, prefix: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS records FROM {{{prefix}{name}}}"


def stored_counts(t: Tables, root: str, names: list[str]) -> DataFrame:
    return O.table_row_counts({n: t.spark.read.parquet(f"{root}/{n}") for n in names})


WRITTEN_SQL = "\nUNION ALL ".join(sums_sql(n, "stored_") for n in REALTIME_TABLES)


@query("K2_write_realtime", WRITTEN_SQL)
def _(t: Tables) -> DataFrame:
    root = shared_dir(t.spark, "realtime")
    messages = M.feed_messages(t).where("error is null and message is not null")
    load_messages(messages, endpoints(t), t["versions"], root, 0)
    return stored_counts(t, root, REALTIME_TABLES)


@query("K3_publish_events", f"SELECT channel, payload, event_time FROM ({N1}) AS n")
def _(t: Tables) -> DataFrame:
    path = shared_dir(t.spark, "events")
    sinks.publish_events(N.stop_departure_events(stop_updates(t)), path)
    return t.spark.read.parquet(path)


# ---- retention -------------------------------------------------------------------------------------

CUTOFF = "TIMESTAMP '2024-01-15 00:00:00'"
GONE = f"SELECT * FROM {{trip_updates}} WHERE timestamp < {CUTOFF}"
SLICES = f"""
SELECT CAST((epoch_us(timestamp) - epoch_us((SELECT min(timestamp) FROM ({GONE}) AS g))) // (%d * CAST(1000000 AS BIGINT)) + 1 AS INT)
       AS batch_number, count(*) AS records_deleted FROM ({GONE}) AS x GROUP BY 1"""


def limit() -> Column:
    return D.cutoff(RETENTION, 7)


@query("D1_retain_trip_updates", f"""
SELECT trip_update_id FROM {{trip_updates}} WHERE timestamp IS NULL OR timestamp >= {CUTOFF}""")
def _(t: Tables) -> DataFrame:
    return D.keep_trip_updates(t["trip_updates"], limit()).select("trip_update_id")


@query("D1_trip_update_slices", SLICES % 10000)
def _(t: Tables) -> DataFrame:
    return D.trip_update_slices(t["trip_updates"], limit(), 10000)


@query("D2_retain_stop_time_updates", f"""
SELECT stop_time_update_id, 'kept' AS fate FROM {{stop_time_updates}}
WHERE trip_update_id NOT IN (SELECT trip_update_id FROM ({GONE}) AS g)
UNION ALL SELECT stop_time_update_id, 'dropped' FROM {{stop_time_updates}}
WHERE trip_update_id IN (SELECT trip_update_id FROM ({GONE}) AS g)""")
def _(t: Tables) -> DataFrame:
    parents = D.keep_trip_updates(t["trip_updates"], limit())
    kept = D.keep_children(t["stop_time_updates"], parents, "trip_update_id")
    gone = D.drop_children(t["stop_time_updates"], parents, "trip_update_id")
    return (kept.select("stop_time_update_id", F.lit("kept").alias("fate"))
            .unionByName(gone.select("stop_time_update_id", F.lit("dropped").alias("fate"))))


@query("D3_retain_vehicle_positions", f"""
SELECT vehicle_position_id FROM {{vehicle_positions}} WHERE feed_message_id NOT IN
  (SELECT feed_message_id FROM {{feed_messages}} WHERE timestamp < {CUTOFF})""")
def _(t: Tables) -> DataFrame:
    return D.keep_vehicle_positions(t["vehicle_positions"], t["feed_messages"], limit()).select(
        "vehicle_position_id")


EXPIRED = f"""
SELECT DISTINCT alert_id FROM {{alert_active_periods}} AS p
WHERE coalesce(end_time, epoch(TIMESTAMP '{RETENTION}')) < epoch({CUTOFF}) AND NOT EXISTS (
  SELECT 1 FROM {{alert_active_periods}} AS q WHERE q.alert_id = p.alert_id
    AND coalesce(end_time, epoch(TIMESTAMP '{RETENTION}')) >= epoch({CUTOFF}))"""


@query("D4_expired_alerts", EXPIRED)
def _(t: Tables) -> DataFrame:
    return D.expired_alerts(t["alert_active_periods"], limit(), RETENTION)


KEPT_FEEDS = f"(SELECT feed_message_id FROM {{feed_messages}} WHERE timestamp >= {CUTOFF})"


def cascade_sql(kept_feeds: str) -> str:
    inner = lambda n: f"SELECT * FROM {{{n}}} WHERE feed_message_id IN {kept_feeds}"
    parts = [f"SELECT 'feed_messages' AS table_name, count(*) AS records FROM {kept_feeds} AS k"]
    parts += [f"SELECT '{n}', count(*) FROM ({inner(n)}) AS x"
              for n in ("vehicle_positions", "trip_updates", "alerts")]
    parts.append("SELECT 'stop_time_updates', count(*) FROM {stop_time_updates} WHERE trip_update_id IN "
                 f"(SELECT trip_update_id FROM ({inner('trip_updates')}) AS x)")
    parts += [f"SELECT '{n}', count(*) FROM {{{n}}} WHERE alert_id IN (SELECT alert_id FROM ({inner('alerts')}) AS x)"
              for n in ("alert_active_periods", "alert_informed_entities", "alert_translations")]
    return "\nUNION ALL ".join(parts)


@query("D5_retain_feed_messages", cascade_sql(KEPT_FEEDS))
def _(t: Tables) -> DataFrame:
    feeds_kept = D.keep_feed_messages(t["feed_messages"], limit())
    return O.table_row_counts(D.cascade(t.pick(*REALTIME_TABLES), feeds_kept))


@query("D5_quarter_hour_retention", cascade_sql(
    f"(SELECT feed_message_id FROM {{feed_messages}} WHERE received_at >= {NOW} - INTERVAL 15 MINUTE)"))
def _(t: Tables) -> DataFrame:
    since = live_clock(t) - F.expr("INTERVAL 15 MINUTES")
    feeds_kept = D.keep_feed_messages(t["feed_messages"], since, "received_at")
    return O.table_row_counts(D.cascade(t.pick(*REALTIME_TABLES), feeds_kept))


TOTALS = f"""
SELECT 'trip_updates' AS table_name, 0 AS batch_number, count(*) AS records_deleted FROM ({GONE}) AS g
UNION ALL SELECT 'stop_time_updates', 0, count(*) FROM {{stop_time_updates}}
  WHERE trip_update_id IN (SELECT trip_update_id FROM ({GONE}) AS g)
UNION ALL SELECT 'vehicle_positions', 0, count(*) FROM {{vehicle_positions}} WHERE feed_message_id IN
  (SELECT feed_message_id FROM {{feed_messages}} WHERE timestamp < {CUTOFF})"""


@query("D6_cleanup_report", f"""{TOTALS}
UNION ALL SELECT 'trip_updates', batch_number, records_deleted FROM ({SLICES % 10000}) AS s
UNION ALL SELECT 'alerts', 1, count(*) FROM {{alerts}} WHERE alert_id IN ({EXPIRED})
UNION ALL SELECT 'feed_messages', 1, count(*) FROM {{feed_messages}} WHERE timestamp < {CUTOFF}""")
def _(t: Tables) -> DataFrame:
    return D.cleanup_report(t.pick(*LIVE), RETENTION)


@query("D6_cleanup_summary", f"SELECT table_name, records_deleted FROM ({TOTALS}) AS r")
def _(t: Tables) -> DataFrame:
    return D.cleanup_summary(t.pick(*LIVE), RETENTION)


AFTER = {
    "feed_messages": f"SELECT * FROM {{feed_messages}} WHERE timestamp >= {CUTOFF}",
    "vehicle_positions": f"SELECT * FROM {{vehicle_positions}} WHERE feed_message_id IN {KEPT_FEEDS}",
    "trip_updates": f"SELECT * FROM {{trip_updates}} WHERE feed_message_id IN {KEPT_FEEDS} "
                    f"AND (timestamp IS NULL OR timestamp >= {CUTOFF})",
    "alerts": f"SELECT * FROM {{alerts}} WHERE feed_message_id IN {KEPT_FEEDS} AND alert_id NOT IN ({EXPIRED})",
}
AFTER["stop_time_updates"] = ("SELECT * FROM {stop_time_updates} WHERE trip_update_id IN "
                              f"(SELECT trip_update_id FROM ({AFTER['trip_updates']}) AS x)")
for _name in ("alert_active_periods", "alert_informed_entities", "alert_translations"):
    AFTER[_name] = (f"SELECT * FROM {{{_name}}} WHERE alert_id IN "
                    f"(SELECT alert_id FROM ({AFTER['alerts']}) AS x)")


@query("D6_after_cleanup", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS records FROM ({sql}) AS x" for n, sql in AFTER.items()))
def _(t: Tables) -> DataFrame:
    return O.table_row_counts(D.after_cleanup(t.pick(*REALTIME_TABLES), RETENTION))


MAIN = ["vehicle_positions", "trip_updates", "alerts"]


@query("D7_realtime_by_source", "\nUNION ALL ".join(
    [f"SELECT '{n}' AS data_type, source_id, count(*) AS records FROM {{{n}}} JOIN {{feed_messages}} "
     "USING (feed_message_id) GROUP BY ALL" for n in MAIN]
    + [f"SELECT 'stop_time_updates', f.source_id, count(*) FROM {UPDATES} GROUP BY ALL",
       "SELECT 'feed_messages', source_id, count(*) FROM {feed_messages} GROUP BY ALL"]))
def _(t: Tables) -> DataFrame:
    return D.rows_by_source(t.pick(*LIVE))


@query("D7_without_source", "\nUNION ALL ".join(
    [f"SELECT '{n}' AS table_name, count(*) AS records FROM {{{n}}} JOIN {{feed_messages}} "
     "USING (feed_message_id) WHERE source_id <> 2" for n in MAIN]
    + [f"SELECT 'stop_time_updates', count(*) FROM {UPDATES} WHERE f.source_id <> 2",
       "SELECT 'feed_messages', count(*) FROM {feed_messages} WHERE source_id <> 2"]))
def _(t: Tables) -> DataFrame:
    live = t.pick(*LIVE)
    return O.table_row_counts({n: D.without_source(live, n, 2)
                               for n in [*MAIN, "stop_time_updates", "feed_messages"]})


@query("D8_purge_realtime", "\nUNION ALL ".join(
    sums_sql(n, "").replace("records", "records_deleted") for n in REALTIME_TABLES))
def _(t: Tables) -> DataFrame:
    return D.purge_report(t.pick(*REALTIME_TABLES))


# ---- removal in place -----------------------------------------------------------------------------

ROW_KEYS = {"feed_messages": "feed_message_id", "vehicle_positions": "vehicle_position_id",
            "trip_updates": "trip_update_id", "stop_time_updates": "trip_update_id || ':' || stop_sequence",
            "alerts": "alert_id", "alert_active_periods": "alert_id || ':' || start_time",
            "alert_informed_entities": "alert_id || ':' || coalesce(route_id, '') || ':' || coalesce(stop_id, '')",
            "alert_translations": "alert_id || ':' || field_type"}


def flat(sql: str) -> str:
    """``sql`` over the tables an ingest job makes of the nested messages."""
    for name in REALTIME_TABLES:
        sql = sql.replace(f"{{{name}}}", f"{{stored_{name}}}")
    return sql


def left_sql(tables: dict[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{n}' AS table_name, {ROW_KEYS[n]} AS row_key FROM ({flat(sql)}) AS x"
                               for n, sql in tables.items())


def stored_halves(t: Tables) -> str:
    """The messages as an ingest job leaves them, in two batches."""
    root = shared_dir(t.spark, "realtime")
    messages = M.feed_messages(t).where("error is null and message is not null")
    half = F.col("received_at") < F.lit("2024-01-16").cast("timestamp")
    for number, part in enumerate((messages.where(half), messages.where(~half))):
        load_messages(part, endpoints(t), t["versions"], root, number)
    return root


def rows_left(t: Tables, root: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        t.spark.read.parquet(f"{root}/{n}").select(F.lit(n).alias("table_name"), F.expr(key).alias("row_key"))
        for n, key in ROW_KEYS.items()])


@query("D5_clean_in_place", left_sql(AFTER))
def _(t: Tables) -> DataFrame:
    root = stored_halves(t)
    upkeep.clean_realtime(t.spark, root, RETENTION)
    return rows_left(t, root)


def folded_halves(t: Tables) -> str:
    """The messages in four batches, folded by day; the newest is left alone."""
    root = shared_dir(t.spark, "folded")
    messages = M.feed_messages(t).where("error is null and message is not null")
    for number, part in enumerate(HALVES):
        load_messages(messages.where(part), endpoints(t), t["versions"], root, number)
    folding.fold_days(t.spark, root, RETENTION)
    return root


def rows_read(t: Tables, root: str) -> DataFrame:
    live = sinks.read_batches(t.spark, root, REALTIME_TABLES)
    return reduce(DataFrame.unionByName, [
        live[n].select(F.lit(n).alias("table_name"), F.expr(key).alias("row_key"))
        for n, key in ROW_KEYS.items()])


# Batches by arrival: days before the fifteenth, two halves of that day, and all later ones.
DAY_START, DAY_END = (f"received_at < TIMESTAMP '2024-01-{day} 00:00:00'" for day in (15, 16))
HALVES = [DAY_START]
HALVES += [f"NOT ({DAY_START}) AND {DAY_END} AND extract(hour FROM received_at) BETWEEN {12 * i} AND {12 * i + 11}"
             for i in range(2)]
HALVES.append(f"NOT ({DAY_END})")


@query("K2_fold_days", left_sql({n: f"SELECT * FROM {{{n}}}" for n in REALTIME_TABLES}))
def _(t: Tables) -> DataFrame:
    return rows_read(t, folded_halves(t))


# Earlier days are one batch and the fifteenth another; each goes once its newest stamp is before the limit.
DAY_LIMIT = "2024-01-16 12:00:00"
STAYS = (f"(SELECT coalesce(max(timestamp) >= TIMESTAMP '{DAY_LIMIT}', true) OR bool_or(timestamp IS NULL) "
         "FROM {feed_messages} WHERE ")
LATER = (f"(SELECT feed_message_id FROM {{feed_messages}} WHERE NOT ({DAY_END}) OR ({DAY_START} AND {STAYS}{DAY_START})) "
         f"OR (NOT ({DAY_START}) AND {DAY_END} AND {STAYS}NOT ({DAY_START}) AND {DAY_END})))")


def of_messages(kept: str) -> dict[str, str]:
    """SQL of the realtime tables once only the messages ``kept`` are left."""
    rows = {n: f"SELECT * FROM {{{n}}} WHERE feed_message_id IN {kept}" for n in ("feed_messages", *MAIN)}
    for name in REALTIME_TABLES:
        if name not in rows:
            key, parent = (("trip_update_id", "trip_updates") if name == "stop_time_updates"
                           else ("alert_id", "alerts"))
            rows[name] = f"SELECT * FROM {{{name}}} WHERE {key} IN (SELECT {key} FROM ({rows[parent]}) AS p)"
    return rows


@query("D5_drop_days", left_sql(of_messages(LATER)))
def _(t: Tables) -> DataFrame:
    root = folded_halves(t)
    folding.drop_days(t.spark, root, DAY_LIMIT)
    return rows_read(t, root)


OTHERS = "(SELECT feed_message_id FROM {feed_messages} WHERE source_id <> 2)"
OTHER_ROWS = {n: f"SELECT * FROM {{{n}}} WHERE feed_message_id IN {OTHERS}" for n in ("feed_messages", *MAIN)}
for _name in REALTIME_TABLES:
    if _name not in OTHER_ROWS:
        _key, _parent = (("trip_update_id", "trip_updates") if _name == "stop_time_updates"
                         else ("alert_id", "alerts"))
        OTHER_ROWS[_name] = (f"SELECT * FROM {{{_name}}} WHERE {_key} IN "
                             f"(SELECT {_key} FROM ({OTHER_ROWS[_parent]}) AS p)")


@query("D7_remove_source", left_sql(OTHER_ROWS))
def _(t: Tables) -> DataFrame:
    root = stored_halves(t)
    upkeep.remove_source(t.spark, root, 2)
    return rows_left(t, root)


@query("D8_purge_in_place", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS records_deleted, CAST(0 AS BIGINT) AS records_left FROM {{stored_{n}}}"
    for n in REALTIME_TABLES))
def _(t: Tables) -> DataFrame:
    root = stored_halves(t)
    removed = upkeep.purge_realtime(t.spark, root)
    held = rows_left(t, root).groupBy("table_name").agg(F.count(F.lit(1)).alias("records_left"))
    return (removed.join(held, "table_name", "left")
            .select("table_name", "records_deleted", F.coalesce("records_left", F.lit(0)).alias("records_left")))


@query("D9_data_age_health", f"""
SELECT 'Oldest Real-time Data' AS metric, days || ' days ago' AS value,
       CASE WHEN days > 30 THEN 'WARNING' WHEN days > 7 THEN 'CAUTION' ELSE 'OK' END AS status,
       CASE WHEN days > 30 THEN 'Run cleanup with a retention of 7 days'
            WHEN days > 7 THEN 'Consider running cleanup soon' ELSE 'Data freshness is good' END AS recommendation
FROM (SELECT CAST(floor(epoch(TIMESTAMP '{RETENTION}' - min(timestamp)) / 86400) AS INT) AS days
      FROM {{trip_updates}}) AS x""")
def _(t: Tables) -> DataFrame:
    return D.data_age_health(t["trip_updates"], RETENTION)


# ---- monitoring -----------------------------------------------------------------------------------


@query("M1_processor_stats", f"""
SELECT feed_type, source_id, count(*) AS messages, CAST(sum(n) AS BIGINT) AS entities,
       CAST(sum(CASE WHEN kind = 0 THEN filled ELSE 0 END) AS BIGINT) AS vehicle_positions,
       CAST(sum(CASE WHEN kind = 1 THEN filled ELSE 0 END) AS BIGINT) AS trip_updates,
       CAST(sum(CASE WHEN kind = 2 THEN filled ELSE 0 END) AS BIGINT) AS service_alerts,
       {ts("max(received_at)")} AS last_processed
FROM (SELECT t.*, (SELECT count(*) FROM {{fx_ev}} AS e WHERE e.feed_message_id = t.m) AS n,
             (SELECT count(*) FROM {{fx_ev}} AS e WHERE e.feed_message_id = t.m AND e.event_id % 29 <> 0) AS filled
      FROM {{tagged}} AS t) AS x GROUP BY feed_type, source_id""")
def _(t: Tables) -> DataFrame:
    return O.processor_stats(tagged(t))


@query("M2_feed_freshness", f"""
SELECT source_id, feed_type, {ts("max(received_at)")} AS newest,
       CAST(floor(epoch({NOW})) - floor(epoch(max(received_at))) AS BIGINT) AS age_seconds
FROM {{feed_messages}} GROUP BY source_id, feed_type""")
def _(t: Tables) -> DataFrame:
    return O.feed_freshness(t["feed_messages"], live_clock(t))


@query("M3_table_row_counts", "\nUNION ALL ".join(sums_sql(n, "") for n in REALTIME_TABLES))
def _(t: Tables) -> DataFrame:
    return O.table_row_counts(t.pick(*REALTIME_TABLES))


# ---- streams ----------------------------------------------------------------------------------------


def run_stream(t: Tables, job, *args, **options) -> str:
    """Run a job over the stored messages until they are worked off; its output folder."""
    source = feeds.stream_feed_messages(t.spark, message_files(t))
    root, checkpoint = shared_dir(t.spark, "stream"), shared_dir(t.spark, "progress")
    job(source, endpoints(t), *args, root, checkpoint, **options).awaitTermination()
    return root


@query("W1_ingest_feeds", WRITTEN_SQL)
def _(t: Tables) -> DataFrame:
    root = run_stream(t, jobs.ingest_feeds, lambda: t["versions"])
    return stored_counts(t, root, REALTIME_TABLES)


@query("W1_ingested_rows", left_sql({n: f"SELECT * FROM {{{n}}}" for n in REALTIME_TABLES}))
def _(t: Tables) -> DataFrame:
    """The keys of all rows the ingest job has written."""
    return rows_left(t, run_stream(t, jobs.ingest_feeds, lambda: t["versions"]))


JUDGED_SQL = f"""
SELECT CASE WHEN kind_ = 6 AND NOT failed THEN NULL WHEN unknown THEN 'elsewhere'
            ELSE CASE WHEN half = 0 THEN 'tram_' ELSE 'metrotrain_' END || feed_type END AS endpoint,
       CASE WHEN kind_ <> 6 OR failed THEN received_at END AS received_at,
       CASE WHEN failed THEN 'failed fetch' WHEN kind_ = 6 THEN 'unreadable line'
            WHEN unknown THEN 'unknown endpoint' WHEN kind_ = 1 THEN 'no header'
            WHEN kind_ = 4 THEN 'entity without id' WHEN kind_ = 3 THEN 'repeated entity id'
            WHEN kind_ = 5 AND EXISTS (SELECT 1 FROM {{fx_ev}} AS e WHERE e.feed_message_id = m AND kind = 0
                AND event_id % 29 <> 0 AND event_id % 23 <> 0) THEN 'number out of range'
            WHEN kind_ = 2 THEN 'stamp out of range'
            WHEN kind_ = 7 AND EXISTS (SELECT 1 FROM {{fx_ev}} AS e WHERE e.feed_message_id = m AND kind = 0
                AND event_id % 29 <> 0 AND event_id % 23 <> 0) THEN 'position without coordinates'
            WHEN kind_ = 10 AND kind = 2 AND EXISTS (SELECT 1 FROM {{fx_ev}} AS e WHERE e.feed_message_id = m
                AND event_id % 29 <> 0) THEN 'translation without text'
            WHEN kind_ = 9 AND EXISTS (SELECT 1 FROM {{fx_ev}} AS e WHERE e.feed_message_id = m AND kind = 1
                AND event_id % 29 <> 0 AND event_id % 19 <> 0 AND event_id % 3 <> 0) THEN 'repeated stop'
            WHEN EXISTS (SELECT 1 FROM {{fx_ev}} AS e WHERE e.feed_message_id = m AND {REPEATED_STOP}) THEN 'repeated stop'
            WHEN kind_ = 8 AND EXISTS (SELECT 1 FROM {{fx_ev}} AS e WHERE e.feed_message_id = m
                AND CASE kind WHEN 0 THEN event_id % 29 <> 0 AND event_id % 23 <> 0
                    WHEN 1 THEN event_id % 29 <> 0 AND event_id % 19 <> 0 ELSE true END) THEN 'text too long'
            WHEN copy = 1 THEN 'repeated message' END AS reason
FROM (SELECT *, m // 20 % 13 AS kind_ FROM {{fetches}}) AS f, (VALUES (0), (1)) AS c (copy)
WHERE copy = 0 OR (kind_ = 11 AND NOT failed)"""


@query("S4_rejected_messages", f"""
SELECT endpoint, {ts("received_at")} AS received_at, reason FROM ({JUDGED_SQL}) AS j WHERE reason IS NOT NULL
UNION ALL
SELECT endpoint, {ts("received_at")}, 'taken' FROM ({JUDGED_SQL}) AS j WHERE reason IS NULL""")
def _(t: Tables) -> DataFrame:
    """Damaged messages run through the ingest job: what it refused, and what it took all the same."""
    path, root, progress = [shared_dir(t.spark, x) for x in ("damaged", "stream", "progress")]
    M.damaged_lines(t).write.text(path)
    jobs.ingest_feeds(feeds.stream_all_messages(t.spark, path), endpoints(t), lambda: t["versions"],
                      root, progress).awaitTermination()
    refused = t.spark.read.parquet(f"{root}/rejected_messages").select("endpoint", "received_at", "reason")
    taken = (t.spark.read.parquet(f"{root}/feed_messages")
             .join(endpoints(t).select("endpoint", "source_id", "feed_type"), ["source_id", "feed_type"])
             .select("endpoint", "received_at", F.lit("taken").alias("reason")))
    return refused.unionByName(taken)


@query("S4_replayed_files", f"""
SELECT 'feed_messages' AS table_name, feed_message_id AS row_key FROM {{stored_feed_messages}}
UNION ALL SELECT 'refused', feed_message_id || ' stored message' FROM {{stored_feed_messages}}""")
def _(t: Tables) -> DataFrame:
    """A file that arrives again under a new name: the rows stay as they were, its messages are listed."""
    root = shared_dir(t.spark, "replayed")
    messages = stored_messages(t)
    for number in range(2):
        load_messages(messages, endpoints(t), t["versions"], root, number)
    held = t.spark.read.parquet(f"{root}/feed_messages").select(
        F.lit("feed_messages").alias("table_name"), F.col("feed_message_id").alias("row_key"))
    refused = (t.spark.read.parquet(f"{root}/rejected_messages").where("reason = 'stored message'")
               .join(endpoints(t), "endpoint")
               .select(F.lit("refused").alias("table_name"), F.concat_ws(
                   " ", feeds.feed_key(F.col("source_id"), F.col("feed_type"), F.col("received_at")),
                   "reason").alias("row_key")))
    return held.unionByName(refused)


def spoilt_columns(name: str) -> list[str]:
    """Select list, for both engines, that breaks every rule of a realtime table in some rows."""
    known = "alert_id" if name.startswith("alert") else (
        "trip_update_id" if name in ("trip_updates", "stop_time_updates") else "feed_message_id")
    texts, filled = MAX_LENGTH.get(name, {}), NOT_NULL[name]
    return [f"CASE WHEN length({known}) % {len(filled) + 1} = {filled.index(c) if c in filled else -1} THEN NULL "
            f"ELSE {f'CASE WHEN length({known}) % 2 = 0 THEN repeat({c}, 60) ELSE {c} END' if c in texts else c} "
            f"END AS {c}" for c in dict.fromkeys([*filled, *texts])]


@query("Q4_not_null_and_length_live", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{rule}' AS rule, count(*) AS violations "
    f"FROM (SELECT {', '.join(spoilt_columns(n))} FROM {{flat_{n}}}) AS x WHERE {broken}"
    for n in REALTIME_TABLES for rule, broken in [
        *[(f"{c} is null", f"{c} IS NULL") for c in NOT_NULL[n]],
        *[(f"{c} longer than {k}", f"length({c}) > {k}") for c, k in MAX_LENGTH.get(n, {}).items()]]))
def _(t: Tables) -> DataFrame:
    rows = tagged(t)
    return Q.not_null_and_length({n: R.REALTIME_ROWS[n](rows).selectExpr(*spoilt_columns(n))
                                  for n in REALTIME_TABLES})


@query("Q2_fk_orphans_sources", f"""
SELECT 'feed_messages' AS child, 'source_id' AS column_name, 'transport_sources' AS parent,
       count(*) AS orphan_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows
FROM (SELECT source_id, count(*) AS n FROM {{flat_feed_messages}} WHERE source_id <> 3 GROUP BY 1) AS x
UNION ALL
SELECT 'feed_messages', 'version_id', 'versions', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
FROM (SELECT version_id, count(*) AS n FROM {{flat_feed_messages}} GROUP BY 1
      HAVING version_id NOT IN (SELECT version_id FROM {{versions}} WHERE NOT is_active)) AS x""")
def _(t: Tables) -> DataFrame:
    """Messages of a source and of a version that the lookups lack."""
    return Q.fk_orphans({"feed_messages": R.feed_messages(tagged(t)),
                         "transport_sources": lookups.transport_sources(t.spark).where("source_id = 3"),
                         "versions": t["versions"].where("not is_active")})


EVENT_KINDS = ["N1_stop_departures", "N2_vehicle_positions", "N3_vehicle_at_stop", "N4_service_alerts_update",
               "N5_service_alerts_route", "N6_service_alerts_stop", "N7_feed_messages", "N8_trip_updates"]


def nested_events(kind: str) -> str:
    """SQL of a kind of event over the nested messages. Their positions are decimals, written
    with all their places; the check engine's JSON only keeps those as text, so the quotes go."""
    sql = flat(SQL[kind].replace(NOW, f"TIMESTAMP '{RETENTION}'"))
    for column, form in (("latitude", "10,7"), ("longitude", "10,7"), ("bearing", "5,2")):
        sql = sql.replace(f"v.{column}", f"CAST(CAST(v.{column} AS DECIMAL({form})) AS VARCHAR)")
    bare = """regexp_replace(payload, '"(latitude|longitude|bearing)":"([-0-9.]+)"', '"\\1":\\2', 'g')"""
    return f"SELECT channel, {bare} AS payload, event_time FROM ({sql}) AS x"


@query("W2_event_stream", "\nUNION ALL ".join(map(nested_events, EVENT_KINDS)))
def _(t: Tables) -> DataFrame:
    root = run_stream(t, jobs.event_stream, lambda: t["versions"], as_of=RETENTION)
    return t.spark.read.parquet(f"{root}/events").select("channel", "payload", "event_time")


@query("W3_latest_vehicle", f"""
SELECT source_id, vehicle_id, trip_id, route_id, latitude, longitude, current_status, stop_id,
       {ts("timestamp")} AS timestamp
FROM (SELECT f.source_id, v.*, row_number() OVER (PARTITION BY f.source_id, v.vehicle_id
          ORDER BY v.timestamp DESC, v.vehicle_position_id DESC) AS rn
      FROM {{flat_vehicle_positions}} AS v JOIN {{tagged}} AS f ON f.fk = v.feed_message_id
      WHERE v.vehicle_id IS NOT NULL) AS x WHERE rn = 1""")
def _(t: Tables) -> DataFrame:
    root = run_stream(t, jobs.latest_vehicle, t["versions"])
    return jobs.latest_per_key(t.spark, root, ["source_id", "vehicle_id"])


def in_batches(t: Tables, job, *args, files: int = 4, between=None) -> tuple[str, str]:
    """Run a job over the stored messages in ``files`` runs, each over files that arrived since;
    ``between`` is called with its output folder after each. Output and checkpoint folders."""
    arrived, root, checkpoint = [shared_dir(t.spark, x) for x in ("arrived", "stream", "progress")]
    messages = M.feed_messages(t).withColumn("part", F.pmod(F.xxhash64("received_at"), F.lit(files)))
    messages.persist()
    for part in range(files):
        (messages.where(F.col("part") == part).drop("part").write.mode("append")
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(arrived))
        source = feeds.stream_feed_messages(t.spark, arrived)
        job(source, endpoints(t), *args, root, checkpoint).awaitTermination()
        if between:
            between(root)
    messages.unpersist()
    return root, checkpoint


VEHICLE_KEY = ["source_id", "vehicle_id"]


@query("W3_latest_folded", SQL["W3_latest_vehicle"])
def _(t: Tables) -> DataFrame:
    """Four batches, in no order of time, each folded into the rows of the ones before."""
    root, _ = in_batches(t, jobs.latest_vehicle, t["versions"],
                         between=lambda at: jobs.fold_latest(t.spark, at, VEHICLE_KEY))
    return jobs.latest_per_key(t.spark, root, VEHICLE_KEY)


@query("W3_latest_in_state", SQL["W3_latest_vehicle"])
def _(t: Tables) -> DataFrame:
    _, checkpoint = in_batches(t, jobs.latest_vehicle, t["versions"], files=2)
    return jobs.latest_in_state(t.spark, checkpoint)


@query("W4_windowed_activity", f"""
SELECT {ts("w")} AS window_start, {ts("w + INTERVAL 1 HOUR")} AS window_end, source_id, trip_id, count(*) AS updates
FROM (SELECT u.trip_id, f.source_id, time_bucket(INTERVAL 30 MINUTE, f.received_at) - (n - 1) * INTERVAL 30 MINUTE AS w
      FROM (SELECT *, {{twice}} AS n FROM {{flat_trip_updates}}) AS u
      JOIN {{tagged}} AS f ON f.fk = u.feed_message_id) AS x
GROUP BY w, source_id, trip_id""")
def _(t: Tables) -> DataFrame:
    root = run_stream(t, jobs.windowed_activity, t["versions"])
    return jobs.latest_per_key(t.spark, root, ["window_start", "window_end", "source_id", "trip_id"])


@query("W5_stateful_retention", f"""
SELECT source_id, feed_type, {ts("received_at")} AS received_at,
       CASE WHEN m % 100 <> 0 THEN {ts("feed_time")} END AS message_time, 'E' || e.event_id AS entity_id
FROM {{tagged}} AS f JOIN {{fx_ev}} AS e ON e.feed_message_id = f.m""")
def _(t: Tables) -> DataFrame:
    root = run_stream(t, jobs.distinct_entities, t["versions"])
    return t.spark.read.parquet(root).drop("batch_id")
