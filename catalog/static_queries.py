"""Column functions, schedule files, typed rows, quality rules and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog.derived import SCHEDULE, Tables
from catalog.registry import MORNING, SHARED_SQL, SQL, query, ts
from headway.functions import clocks as C, codes, texts as X
from headway.operators import quality as Q, static_rows as R, versions as V
from headway.operators.services import upcoming_services
from headway.operators.stops import stop_routes
from headway.plans.schedule_load import MAY_BE_BLANK, load_schedule
from headway.schemas import (
    FOREIGN_KEYS, MAX_LENGTH, NOT_NULL, PRIMARY_KEYS, SCOPE, STATIC_TABLES,
    VALUE_RANGES, VERSIONS, WEEKDAYS)
from headway.session import shared_dir
from headway.sources import gtfs_files, lookups, portal, sinks

VERSION = 5

# ---- column functions -------------------------------------------------------------------


def secs_sql(x: str) -> str:
    part = lambda i: f"CAST(replace(split_part({x}, ':', {i}), '+', '') AS BIGINT)"
    return (f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+:[+-]?[0-9]+:[+-]?[0-9]+') "
            f"THEN CAST({part(1)} * 3600 + {part(2)} * 60 + {part(3)} AS INT) END")


def date_sql(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '[0-9]{{8}}') THEN TRY_CAST(substr({x}, 1, 4) || '-' || "
            f"substr({x}, 5, 2) || '-' || substr({x}, 7, 2) AS DATE) END")


@query("F1_gtfs_time_to_seconds", f"""
SELECT trip_id, stop_id, stop_sequence, {secs_sql("arrival_time")} AS as_received,
       {secs_sql("trim(arrival_time)")} AS stripped, {secs_sql("departure_time")} AS departure
FROM {{raw_stop_times}}""")
def _(t: Tables) -> DataFrame:
    arrival, departure = F.col("arrival_time"), F.col("departure_time")
    return t["raw_stop_times"].select(
        "trip_id", "stop_id", "stop_sequence", C.gtfs_time_to_seconds(arrival).alias("as_received"),
        C.gtfs_time_to_seconds(X.cell(arrival)).alias("stripped"),
        C.gtfs_time_to_seconds(departure).alias("departure"))


@query("F2_clock_to_seconds", f"""
SELECT trip_id, stop_id, stop_sequence,
       CASE WHEN regexp_full_match(departure_time, '([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]')
            THEN {secs_sql("departure_time")} END AS seconds
FROM {{raw_stop_times}}""")
def _(t: Tables) -> DataFrame:
    return t["raw_stop_times"].select("trip_id", "stop_id", "stop_sequence",
                                      C.clock_to_seconds(F.col("departure_time")).alias("seconds"))


@query("F3_gtfs_date", f"""
SELECT service_id, {date_sql("date")} AS day FROM {{raw_calendar_dates}}
UNION ALL SELECT service_id, {date_sql("end_date")} FROM {{raw_calendar}}""")
def _(t: Tables) -> DataFrame:
    dates = t["raw_calendar_dates"].select("service_id", C.gtfs_date(F.col("date")).alias("day"))
    return dates.unionByName(
        t["raw_calendar"].select("service_id", C.gtfs_date(F.col("end_date")).alias("day")))


@query("F4_posix_to_timestamp", f"""
SELECT alert_id, {ts("make_timestamp(start_time * 1000000)")} AS starts,
       {ts("make_timestamp(end_time * 1000000)")} AS ends FROM {{alert_active_periods}}""")
def _(t: Tables) -> DataFrame:
    at = lambda c: C.posix_to_timestamp(F.col(c))
    return t["alert_active_periods"].select("alert_id", at("start_time").alias("starts"),
                                            at("end_time").alias("ends"))


def portal_sql(zone: str) -> str:
    naive = f"TRY_CAST(last_modified AS TIMESTAMP) AT TIME ZONE '{zone}' AT TIME ZONE 'UTC'"
    zoned = "TRY_CAST(last_modified AS TIMESTAMPTZ) AT TIME ZONE 'UTC'"
    return (f"CASE WHEN regexp_full_match(last_modified, '.*T[0-9:.]+(Z|[+-][0-9]{{2}}:[0-9]{{2}})') THEN {zoned} "
            f"WHEN regexp_full_match(last_modified, '.*T[0-9:.]+') THEN {naive} END")


@query("F5_portal_timestamp", f"""
SELECT o_orderkey, {ts(portal_sql("UTC"))} AS plain, {ts(portal_sql("Australia/Melbourne"))} AS local
FROM {{portal_text}}""")
def _(t: Tables) -> DataFrame:
    text = F.col("last_modified")
    return t["portal_text"].select(
        "o_orderkey", C.portal_timestamp(text).alias("plain"),
        C.portal_timestamp(text, "Australia/Melbourne").alias("local"))


LOCAL = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Melbourne')"


@query("F6_service_clock", f"""
SELECT id, CAST(hour({LOCAL}) * 3600 + minute({LOCAL}) * 60 + second({LOCAL}) AS INT) AS seconds,
       CAST({LOCAL} AS DATE) AS day, CAST({LOCAL} AS DATE) - 1 AS yesterday
FROM (SELECT event_id AS id, ts FROM events UNION ALL
      SELECT o_orderkey, o_orderdate + INTERVAL 16 HOUR FROM orders) AS x""")
def _(t: Tables) -> DataFrame:
    moments = t["events"].select(F.col("event_id").alias("id"), "ts").union(
        t["orders"].select("o_orderkey", F.expr("o_orderdate + INTERVAL 16 HOURS")))
    clock = C.service_clock(F.col("ts"))
    return moments.select("id", clock.seconds.alias("seconds"), clock.date.alias("day"),
                          clock.yesterday.alias("yesterday"))


@query("F7_effective_seconds", """
SELECT trip_id, source_id, version_id, stop_sequence, CASE WHEN departure_time_seconds >= 86400
       THEN departure_time_seconds - 86400 ELSE departure_time_seconds END AS seconds FROM {stop_times}""")
def _(t: Tables) -> DataFrame:
    seconds = F.col("departure_time_seconds")
    offset = F.when(seconds >= C.DAY, 1).otherwise(0)
    return t["stop_times"].select("trip_id", "source_id", "version_id", "stop_sequence",
                                  C.effective_seconds(seconds, offset).alias("seconds"))


@query("F8_seconds_to_clock", """
SELECT trip_id, source_id, version_id, stop_sequence,
       printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) AS clock
FROM (SELECT *, departure_time_seconds % 86400 AS s FROM {stop_times}) AS x""")
def _(t: Tables) -> DataFrame:
    return t["stop_times"].select("trip_id", "source_id", "version_id", "stop_sequence",
                                  C.seconds_to_clock(F.col("departure_time_seconds")).alias("clock"))


@query("F9_seconds_to_interval", """
SELECT trip_id, source_id, version_id, stop_sequence,
       CAST(epoch(to_seconds(arrival_time_seconds)) AS BIGINT) AS after_midnight FROM {stop_times}""")
def _(t: Tables) -> DataFrame:
    after = C.seconds_to_interval(F.col("arrival_time_seconds"))
    return t["stop_times"].select("trip_id", "source_id", "version_id", "stop_sequence",
                                  after.alias("after_midnight"))


@query("F10_runs_on", """
SELECT c.service_id, c.source_id, c.version_id, d.date,
       [sunday, monday, tuesday, wednesday, thursday, friday, saturday][dayofweek(d.date) + 1] = 1 AS runs
FROM {calendar} AS c JOIN {calendar_dates} AS d USING (service_id, source_id, version_id)""")
def _(t: Tables) -> DataFrame:
    days = t["calendar"].join(t["calendar_dates"], ["service_id", *SCOPE])
    return days.select("service_id", *SCOPE, "date", C.runs_on(F.col("date")).alias("runs"))


@query("F11_relative_position", """
SELECT trip_id, source_id, version_id, stop_sequence,
       CASE WHEN arrival_time_seconds < 28800 THEN 'past' WHEN arrival_time_seconds <= 29100 THEN 'imminent'
            ELSE 'future' END AS position FROM {stop_times}""")
def _(t: Tables) -> DataFrame:
    position = C.relative_position(F.col("arrival_time_seconds"), C.service_clock(MORNING).seconds)
    return t["stop_times"].select("trip_id", "source_id", "version_id", "stop_sequence",
                                  position.alias("position"))


@query("F12_day_age", """
SELECT event_id, CAST(floor((epoch_us(TIMESTAMP '2024-01-14 21:00:00') - epoch_us(ts)) / 86400000000.0) AS INT) AS days
FROM events""")
def _(t: Tables) -> DataFrame:
    return t["events"].select("event_id", C.day_age(MORNING, F.col("ts")).alias("days"))


def labels_sql(kind: str, column: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in codes.CODES[kind].items())
    return f"CASE {column} {whens} END"


@query("F13_code_labels", f"""
SELECT event_id, {labels_sql("trip_relationship", "event_id % 10")} AS trip_relationship,
       {labels_sql("stop_relationship", "event_id % 5")} AS stop_relationship,
       {labels_sql("vehicle_status", "event_id % 4")} AS vehicle_status,
       {labels_sql("cause", "event_id % 14")} AS cause, {labels_sql("effect", "event_id % 13")} AS effect,
       {labels_sql("severity", "event_id % 6")} AS severity,
       {labels_sql("incrementality", "event_id % 3")} AS incrementality
FROM events""")
def _(t: Tables) -> DataFrame:
    spread = {"trip_relationship": 10, "stop_relationship": 5, "vehicle_status": 4, "cause": 14,
              "effect": 13, "severity": 6, "incrementality": 3}
    return t["events"].select("event_id", *[
        codes.code_label(kind, F.col("event_id") % n).alias(kind) for kind, n in spread.items()])


@query("F14_text_building", """
SELECT event_id, concat_ws(':', 'channel', CAST(user_id AS VARCHAR), event_type) AS channel,
       json_object('id', event_id, 'kind', nullif(event_type, 'view'), 'none', NULL) AS payload,
       array_to_string([event_type, CAST(user_id AS VARCHAR)], ',') AS listed,
       coalesce(nullif(event_type, 'click'), 'pressed') AS kind
FROM events""")
def _(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t["events"].select(
        "event_id", X.channel("channel", F.col("user_id"), kind).alias("channel"),
        X.json_payload(id=F.col("event_id"), kind=F.nullif(kind, F.lit("view")),
                       none=F.lit(None).cast("string")).alias("payload"),
        F.array_join(F.array(kind, F.col("user_id").cast("string")), ",").alias("listed"),
        F.coalesce(F.nullif(kind, F.lit("click")), F.lit("pressed")).alias("kind"))


# ---- typed rows -----------------------------------------------------------------------------


def text_sql(c: str) -> str:
    return f"coalesce(trim({c}), '') AS {c}"


def opt_sql(c: str) -> str:
    return f"nullif(trim({c}), '') AS {c}"


def number_sql(c: str) -> str:
    return (f"coalesce(CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') "
            f"THEN CAST(replace(trim({c}), '+', '') AS INT) END, 0)")


def int_sql(c: str) -> str:
    return f"{number_sql(c)} AS {c}"


def real_sql(c: str, kind: str = "DOUBLE", keep_zero: bool = False) -> str:
    number = (f"CASE WHEN regexp_full_match(trim({c}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
              f"THEN CAST(trim({c}) AS DOUBLE) ELSE 0 END")
    number = number if keep_zero else f"nullif({number}, 0)"
    return f"CAST(CAST({number} AS {kind}) AS DOUBLE) AS {c}"


TAIL = f"CAST(source_id AS INT) AS source_id, {VERSION} AS version_id"

TYPED_SQL = {
    "agency": [text_sql("agency_id"), text_sql("agency_name"), opt_sql("agency_url"),
               text_sql("agency_timezone"), opt_sql("agency_lang"), opt_sql("agency_fare_url")],
    "stops": [text_sql("stop_id"), text_sql("stop_name"), real_sql("stop_lat", "DECIMAL(10,7)"),
              real_sql("stop_lon", "DECIMAL(10,7)"), int_sql("location_type"),
              opt_sql("parent_station"), int_sql("wheelchair_boarding"), opt_sql("level_id")],
    "routes": [text_sql("route_id"), opt_sql("agency_id"), opt_sql("route_short_name"),
               opt_sql("route_long_name"), int_sql("route_type"), opt_sql("route_color"),
               opt_sql("route_text_color")],
    "trips": [text_sql("trip_id"), text_sql("route_id"), text_sql("service_id"), opt_sql("shape_id"),
              opt_sql("trip_headsign"), int_sql("direction_id"), opt_sql("block_id"),
              int_sql("wheelchair_accessible")],
    "stop_times": [text_sql("trip_id"), text_sql("stop_id"), int_sql("stop_sequence"),
                   secs_sql("trim(arrival_time)") + " AS arrival_time_seconds",
                   secs_sql("trim(departure_time)") + " AS departure_time_seconds",
                   opt_sql("stop_headsign"), int_sql("pickup_type"), int_sql("drop_off_type"),
                   real_sql("shape_dist_traveled", "DECIMAL(10,2)")],
    "calendar": [text_sql("service_id"), *[int_sql(d) for d in WEEKDAYS],
                 date_sql("trim(start_date)") + " AS start_date",
                 date_sql("trim(end_date)") + " AS end_date"],
    "calendar_dates": [text_sql("service_id"), date_sql("trim(date)") + " AS date",
                       int_sql("exception_type")],
    "shapes": [text_sql("shape_id"), real_sql("shape_pt_lat", "DECIMAL(10,7)", True),
               real_sql("shape_pt_lon", "DECIMAL(10,7)", True), int_sql("shape_pt_sequence"),
               real_sql("shape_dist_traveled", "DECIMAL(10,2)")],
    "levels": [text_sql("level_id"), real_sql("level_index"), opt_sql("level_name")],
    "pathways": [text_sql("pathway_id"), text_sql("from_stop_id"), text_sql("to_stop_id"),
                 int_sql("pathway_mode"), int_sql("is_bidirectional"),
                 f"nullif({number_sql('traversal_time')}, 0) AS traversal_time"],
    "transfers": [text_sql("from_stop_id"), text_sql("to_stop_id"), opt_sql("from_route_id"),
                  opt_sql("to_route_id"), text_sql("from_trip_id"), text_sql("to_trip_id"),
                  int_sql("transfer_type"), f"nullif({number_sql('min_transfer_time')}, 0) AS min_transfer_time"],
}
READABLE = {"calendar": " WHERE start_date IS NOT NULL AND end_date IS NOT NULL",
            "calendar_dates": " WHERE date IS NOT NULL"}


def typed_sql(name: str) -> str:
    rows = f"SELECT {', '.join(TYPED_SQL[name])}, {TAIL} FROM {{raw_{name}}}"
    return f"SELECT * FROM ({rows}) AS typed{READABLE.get(name, '')}"


SHARED_SQL.update({f"typed_{name}": typed_sql(name) for name in STATIC_TABLES})


def typed(t: Tables, name: str) -> DataFrame:
    return R.TYPED[name](t[f"raw_{name}"], VERSION)


PROJECTION_IDS = ["agency", "stops", "routes", "trips", "stop_times", "calendar",
                  "calendar_dates", "shapes", "levels", "pathways", "transfers"]

for number, table in enumerate(PROJECTION_IDS, 1):
    query(f"P{number}_{table}", f"SELECT * FROM {{typed_{table}}}")(
        lambda t, name=table: typed(t, name))


# ---- files, portal, lookups -----------------------------------------------------------------


def files(t: Tables, *names: str) -> str:
    """Hand tables on as schedule files in the shared folder."""
    root = shared_dir(t.spark, "files")
    for name in names:
        gtfs_files.write_gtfs_files(t[f"raw_{name}"], root, name, [1, 2])
    return root


@query("S1_scan_gtfs_file", "SELECT * FROM {typed_stop_times}")
def _(t: Tables) -> DataFrame:
    root = files(t, "stop_times")
    return R.stop_times(gtfs_files.scan_gtfs_file(t.spark, root, "stop_times"), VERSION)


@query("S2_source_from_path", """
SELECT page_id, CAST(nullif(regexp_extract(path, '^([0-9]+)/google_transit/[a-z_]+\\.txt$', 1), '') AS INT) AS source_id
FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url ELSE
        CASE WHEN page_id % 4 = 1 THEN 'x' ELSE '' END || CAST(page_id AS VARCHAR) || '/google_transit/stops.txt' END AS path
      FROM pages) AS p""")
def _(t: Tables) -> DataFrame:
    page = F.col("page_id")
    inside = F.concat(F.when(page % 4 == 1, "x").otherwise(""), page.cast("string"),
                      F.lit("/google_transit/stops.txt"))
    path = F.when(page % 4 == 0, F.col("url")).otherwise(inside)
    return t["pages"].select("page_id", gtfs_files.source_from_path(path).alias("source_id"))


@query("S3_scan_dataset_metadata", f"""
SELECT 'R' || o_orderkey AS resource_id, {ts(portal_sql("UTC"))} AS last_modified, 'ZIP' AS format, url,
       CAST(o_orderkey AS VARCHAR) AS url_resource, o_orderkey % 2 = 0 AS datastore_active
FROM {{portal_text}} WHERE success""")
def _(t: Tables) -> DataFrame:
    return portal_metadata(t).select("resource_id", "last_modified", "format", "url",
                                     "url_resource", "datastore_active")


def portal_metadata(t: Tables) -> DataFrame:
    """Portal answers written as JSON lines and read back."""
    key = F.col("o_orderkey")
    answer = F.struct(
        F.concat(F.lit("R"), key.cast("string")).alias("id"), F.lit("schedule").alias("name"),
        "last_modified", F.lit("ZIP").alias("format"), "url",
        F.when(key % 2 == 0, True).alias("datastore_active"))
    path = shared_dir(t.spark, "portal")
    t["portal_text"].select("success", answer.alias("result")).write.json(path)
    return portal.scan_dataset_metadata(t.spark, path)


@query("S6_transport_sources_upsert", """
SELECT source_id, source_name FROM {new_sources}
UNION ALL SELECT source_id, source_name FROM {old_sources}
WHERE source_id NOT IN (SELECT source_id FROM {new_sources})""")
def _(t: Tables) -> DataFrame:
    return lookups.upsert(t["old_sources"], t["new_sources"], ["source_id"])


# ---- writing ----------------------------------------------------------------------------------


@query("K1_write_version", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, source_id, version_id, count(*) AS records, "
    f"count(DISTINCT {PRIMARY_KEYS[n][0]}) AS keys FROM {{typed_{n}}} GROUP BY ALL"
    for n in STATIC_TABLES))
def _(t: Tables) -> DataFrame:
    root = shared_dir(t.spark, "versions")
    sinks.write_version({n: typed(t, n) for n in STATIC_TABLES}, root)
    stored = sinks.read_version_tables(t.spark, root, STATIC_TABLES)
    counts = None
    for name, df in stored.items():
        part = df.groupBy("source_id", "version_id").agg(
            F.count(F.lit(1)).alias("records"), F.countDistinct(PRIMARY_KEYS[name][0]).alias("keys"))
        part = part.select(F.lit(name).alias("table_name"), "source_id", "version_id", "records", "keys")
        counts = part if counts is None else counts.unionByName(part)
    return counts


@query("K4_refresh_view", """
SELECT 'active_services' AS view_name, 'SUCCESS' AS refresh_status, (SELECT count(*) FROM (
  (SELECT d.i, source_id, service_id FROM range(0, 9) AS d(i), {calendar}
   WHERE version_id = 2 AND DATE '2024-01-14' + CAST(d.i AS INT) BETWEEN start_date AND end_date
     AND [sunday, monday, tuesday, wednesday, thursday, friday, saturday]
         [dayofweek(DATE '2024-01-14' + CAST(d.i AS INT)) + 1] = 1
   UNION SELECT date - DATE '2024-01-14', source_id, service_id FROM {calendar_dates}
   WHERE version_id = 2 AND exception_type = 1 AND date BETWEEN DATE '2024-01-14' AND DATE '2024-01-22')
  EXCEPT SELECT date - DATE '2024-01-14', source_id, service_id FROM {calendar_dates}
  WHERE version_id = 2 AND exception_type = 2) AS a) AS records
UNION ALL
SELECT 'broken', 'ERROR', 0
UNION ALL
SELECT 'stop_routes', 'SUCCESS', (SELECT count(*) FROM (
  SELECT DISTINCT st.source_id, st.stop_id, t.route_id FROM {stop_times} AS st
  JOIN {trips} AS t USING (trip_id, source_id, version_id) JOIN {routes} AS r USING (route_id, source_id, version_id)
  JOIN {agency} AS g USING (agency_id, source_id, version_id) WHERE version_id = 2) AS b)""")
def _(t: Tables) -> DataFrame:
    tables, root = t.pick(*SCHEDULE), shared_dir(t.spark, "views")
    report = sinks.refresh_views(t.spark, root, {
        "stop_routes": lambda: stop_routes(tables),
        "active_services": lambda: upcoming_services(tables, MORNING),
        "broken": lambda: tables["trips"].select("no_such_column")}, MORNING)
    stored = None
    for name in ("stop_routes", "active_services"):
        part = (sinks.load_view(t.spark, root, name).agg(F.count(F.lit(1)).alias("records"))
                .withColumn("view_name", F.lit(name)))
        stored = part if stored is None else stored.unionByName(part)
    return (report.join(stored, "view_name", "left")
            .select("view_name", F.split_part("refresh_status", F.lit(":"), F.lit(1))
                    .alias("refresh_status"), F.coalesce("records", F.lit(0)).alias("records")))


# ---- quality rules ------------------------------------------------------------------------------


def key_sql(columns: list[str]) -> str:
    return " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)


def typed_tables(t: Tables) -> dict[str, DataFrame]:
    return {n: typed(t, n) for n in STATIC_TABLES}


@query("Q1_pk_duplicates", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, {key_sql(PRIMARY_KEYS[n])} AS key, count(*) AS copies "
    f"FROM {{typed_{n}}} GROUP BY {', '.join(PRIMARY_KEYS[n])} HAVING count(*) > 1"
    for n in PRIMARY_KEYS if n in STATIC_TABLES))
def _(t: Tables) -> DataFrame:
    return Q.pk_duplicates(typed_tables(t))


@query("Q1_pk_duplicates_live", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, {key_sql(PRIMARY_KEYS[n]) if n != 'feed_messages' else 'NULL'} AS key, "
    f"count(*) AS copies FROM {{{n}}} GROUP BY {', '.join(PRIMARY_KEYS[n])} HAVING count(*) > 1"
    for n in ("feed_messages", "vehicle_positions", "trip_updates", "stop_time_updates", "alerts")))
def _(t: Tables) -> DataFrame:
    return Q.pk_duplicates(t.pick("feed_messages", "vehicle_positions", "trip_updates",
                                  "stop_time_updates", "alerts"))


def orphans_sql(child: str, columns: list[str], parent: str, keys: list[str], prefix: str) -> str:
    match = " AND ".join(f"p.{k} = c.{c}" for c, k in zip(columns, keys))
    filled = " AND ".join(f"c.{c} IS NOT NULL" for c in columns)
    names = ", ".join(f"c.{c}" for c in columns)
    return (f"SELECT '{child}' AS child, '{columns[0]}' AS column_name, '{parent}' AS parent, "
            f"count(*) AS orphan_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows FROM ("
            f"SELECT {names}, count(*) AS n FROM {{{prefix}{child}}} AS c WHERE {filled} AND NOT EXISTS "
            f"(SELECT 1 FROM {{{prefix}{parent}}} AS p WHERE {match}) GROUP BY {names}) AS o")


@query("Q2_fk_orphans", "\nUNION ALL ".join(
    orphans_sql(c, cc, p, pc, "typed_") for c, cc, p, pc in FOREIGN_KEYS
    if c in STATIC_TABLES and p in STATIC_TABLES))
def _(t: Tables) -> DataFrame:
    return Q.fk_orphans(typed_tables(t))


LIVE_CHECKED = ["feed_messages", "vehicle_positions", "trip_updates", "stop_time_updates", "alerts",
                "alert_active_periods", "alert_informed_entities", "alert_translations", "versions"]


@query("Q2_fk_orphans_live", "\nUNION ALL ".join(
    orphans_sql(c, cc, p, pc, "") for c, cc, p, pc in FOREIGN_KEYS
    if c in LIVE_CHECKED and p in LIVE_CHECKED))
def _(t: Tables) -> DataFrame:
    return Q.fk_orphans(t.pick(*LIVE_CHECKED))


@query("Q3_check_violations", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS rule, count(*) AS violations FROM {{typed_{n}}} "
    f"WHERE {c} NOT BETWEEN {lo} AND {hi}"
    for n, ranges in VALUE_RANGES.items() for c, (lo, hi) in ranges.items()))
def _(t: Tables) -> DataFrame:
    return Q.check_violations(typed_tables(t))


def filled_sql(names: list[str], prefix: str) -> str:
    rules = []
    for n in names:
        rules += [(n, f"{c} is null", f"{c} IS NULL") for c in NOT_NULL[n]]
        rules += [(n, f"{c} longer than {k}", f"length({c}) > {k}") for c, k in MAX_LENGTH.get(n, {}).items()]
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{rule}' AS rule, count(*) AS violations FROM {{{prefix}{n}}} WHERE {broken}"
        for n, rule, broken in rules)


@query("Q4_not_null_and_length", filled_sql([n for n in NOT_NULL if n in STATIC_TABLES], "typed_"))
def _(t: Tables) -> DataFrame:
    return Q.not_null_and_length(typed_tables(t))


def blank_references_sql() -> str:
    """Orphans as a load counts them: a transfer without a trip refers to none."""
    parts = []
    for child, columns, parent, keys in FOREIGN_KEYS:
        if child in STATIC_TABLES and parent in STATIC_TABLES:
            text = orphans_sql(child, columns, parent, keys, "typed_")
            if columns[0] in MAY_BE_BLANK.get(child, []):
                text = text.replace("WHERE c.", f"WHERE c.{columns[0]} <> '' AND c.", 1)
            parts.append(text)
    return "\nUNION ALL ".join(parts)


@query("K1_gated_load", f"""
SELECT table_name, 'repeated key' AS rule, count(*) AS violations FROM ({SQL["Q1_pk_duplicates"]}) AS d GROUP BY 1
UNION ALL
SELECT child, column_name || ' not in ' || parent, orphan_rows FROM ({blank_references_sql()}) AS o WHERE orphan_rows > 0
UNION ALL
SELECT * FROM ({SQL["Q3_check_violations"]}) AS v WHERE violations > 0
UNION ALL
SELECT * FROM ({SQL["Q4_not_null_and_length"]}) AS f WHERE violations > 0
UNION ALL
SELECT * FROM (""" + "\nUNION ALL ".join(
    f"SELECT '{n}', 'source_id not in transport_sources', count(*) AS n FROM {{typed_{n}}} WHERE source_id = 2"
    for n in STATIC_TABLES) + f""") AS s WHERE n > 0
UNION ALL SELECT 'versions', 'active version', {VERSION - 1}""")
def _(t: Tables) -> DataFrame:
    """A drop of all files that breaks rules of every sort: the report, and that it is not active."""
    warehouse = shared_dir(t.spark, "gated")
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in VERSIONS
                        if f.name not in ("version_id", "updated_at", "is_active"))
    sinks.save_versions(t.spark.sql(
        f"SELECT {VERSION - 1} AS version_id, {columns}, timestamp'2023-01-01' AS updated_at, true AS is_active"),
        warehouse, 0)
    newer = t.spark.sql("SELECT 'https://x/abc' AS url, timestamp'2024-01-02' AS last_modified")
    known = t.spark.sql("SELECT 1 AS source_id, 'known' AS source_name")
    load = load_schedule(t.spark, files(t, *STATIC_TABLES), warehouse, newer, MORNING, known)
    report = t.spark.createDataFrame(load.broken, "table_name string, rule string, violations bigint")
    active = sinks.load_versions(t.spark, warehouse).where("is_active").select(
        F.lit("versions").alias("table_name"), F.lit("active version").alias("rule"),
        F.col("version_id").cast("bigint").alias("violations"))
    return report.unionByName(active)


@query("Q5_single_active_version", """
SELECT count(*) AS active_versions, count(*) <= 1 AS passes FROM {version_log} WHERE is_active""")
def _(t: Tables) -> DataFrame:
    return Q.single_active_version(t["version_log"])


def unlisted_sql(column: str, known: str) -> str:
    return (f"SELECT '{column}' AS reference, {column} AS missing_id, source_id, version_id, count(*) AS trips "
            f"FROM {{typed_trips}} AS t WHERE {column} <> '' AND NOT EXISTS (SELECT 1 FROM ({known}) AS k "
            f"WHERE k.{column} = t.{column} AND k.source_id = t.source_id AND k.version_id = t.version_id) GROUP BY ALL")


@query("Q6_unlisted_references", unlisted_sql(
    "service_id", "SELECT service_id, source_id, version_id FROM {typed_calendar} "
                  "UNION ALL SELECT service_id, source_id, version_id FROM {typed_calendar_dates}")
       + "\nUNION ALL " + unlisted_sql("shape_id", "SELECT * FROM {typed_shapes}"))
def _(t: Tables) -> DataFrame:
    return Q.unlisted_references(
        {n: typed(t, n) for n in ("trips", "calendar", "calendar_dates", "shapes")})


# ---- versions -----------------------------------------------------------------------------------

LOG_ROW = f"""version_id, version_name, {ts("created_at")} AS created_at, {ts("updated_at")} AS updated_at,
       is_active"""


@query("V1_active_version", f"SELECT {LOG_ROW} FROM {{version_log}} WHERE is_active")
def _(t: Tables) -> DataFrame:
    return V.active_version(t["version_log"])


@query("V2_has_newer_version", f"""
SELECT o_orderkey, {ts("m")} AS last_modified, m > u AS is_newer
FROM (SELECT o_orderkey, {portal_sql("UTC")} AS m, (SELECT updated_at FROM {{version_log}} WHERE is_active) AS u
      FROM {{portal_text}}) AS x WHERE m IS NOT NULL""")
def _(t: Tables) -> DataFrame:
    answers = t["portal_text"].select(
        "o_orderkey", C.portal_timestamp(F.col("last_modified")).alias("last_modified")).dropna()
    return V.has_newer_version(answers, t["version_log"]).drop("active_updated_at")


NEWEST = f"""
SELECT url, m FROM (SELECT o_orderkey, url, {portal_sql("UTC")} AS m FROM {{portal_text}} WHERE success) AS x
WHERE m IS NOT NULL ORDER BY m DESC, o_orderkey DESC LIMIT 1"""


@query("V3_create_version", f"""
SELECT version_id, version_name, {ts("created_at")} AS created_at, {ts("updated_at")} AS updated_at, is_active,
       NULL AS source_url, NULL AS description FROM {{version_log}}
UNION ALL
SELECT (SELECT CAST(max(version_id) + 1 AS INT) FROM {{version_log}}), strftime(m, 'gtfs_%Y-%m-%d_%H:%M:%S'),
       '2024-01-14 21:00:00.000000', {ts("m")}, false, url,
       'GTFS data imported from ' || url || ' at ' || strftime(m, '%Y-%m-%dT%H:%M:%SZ')
FROM ({NEWEST}) AS n""")
def _(t: Tables) -> DataFrame:
    answers = (t["portal_text"].where("success")
               .withColumn("last_modified", C.portal_timestamp(F.col("last_modified")))
               .where("last_modified is not null"))
    newest = (answers.agg(F.max_by(F.struct("url", "last_modified"),
                                   F.struct("last_modified", "o_orderkey")).alias("n")).select("n.*"))
    return V.create_version(t["version_log"], newest, MORNING)


@query("V4_activate_version", f"""
SELECT {LOG_ROW.replace("is_active", "version_id = 11 AS is_active")} FROM {{version_log}}""")
def _(t: Tables) -> DataFrame:
    return V.activate_version(t["version_log"], 11)


@query("V5_versions_to_delete", """
SELECT version_id, version_name FROM (
  SELECT *, row_number() OVER (ORDER BY created_at DESC, version_id DESC) AS rn FROM {version_log} WHERE NOT is_active
) AS r WHERE rn > 3""")
def _(t: Tables) -> DataFrame:
    return V.versions_to_delete(t["version_log"], 3).select("version_id", "version_name")


VERSIONED = [n for n in SCHEDULE if n not in ("versions", "platform_numbers")]
DOOMED = "SELECT * FROM {versions} WHERE NOT is_active"
REMOVED = (" UNION ALL ".join(f"SELECT version_id FROM {{{n}}}" for n in VERSIONED))


@query("V6_delete_versions", f"""
WITH removed AS (SELECT d.version_id, d.version_name, count(r.version_id) AS records_deleted, 'SUCCESS' AS cleanup_status
  FROM ({DOOMED}) AS d LEFT JOIN ({REMOVED}) AS r ON r.version_id = d.version_id GROUP BY ALL)
SELECT * FROM removed
UNION ALL SELECT NULL, 'CLEANUP_SUMMARY', CAST(sum(records_deleted) AS BIGINT), 'COMPLETED' FROM removed""")
def _(t: Tables) -> DataFrame:
    return V.delete_versions(t["versions"], t.pick(*VERSIONED), keep=0)


@query("V6_surviving_rows", "SELECT version_id, trip_id, stop_sequence FROM {stop_times} WHERE version_id = 2")
def _(t: Tables) -> DataFrame:
    doomed = V.versions_to_delete(t["versions"], 0)
    return V.without_versions(t["stop_times"], doomed).select("version_id", "trip_id", "stop_sequence")


def counted_sql(name: str) -> str:
    return f"(SELECT count(*) FROM {{{name}}} AS c WHERE c.version_id = v.version_id) AS {name}_count"


@query("V7_list_versions_with_counts", f"""
SELECT version_id, version_name, {ts("created_at")} AS created_at, is_active,
       {counted_sql("stop_times")}, {counted_sql("trips")}, {counted_sql("stops")},
       CAST(floor(epoch(TIMESTAMP '2024-01-14 21:00:00' - created_at) / 86400) AS INT) AS age_days
FROM {{versions}} AS v""")
def _(t: Tables) -> DataFrame:
    return V.list_versions_with_counts(t["versions"], t.pick("stop_times", "trips", "stops"), MORNING)
