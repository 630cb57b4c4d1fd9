"""Transit-shaped tables derived from the given ones.

One text per table serves Spark and the SQL check alike. ``{name}`` refers to another table;
``{twice}`` and ``{thrice}`` unfold a row into copies numbered from 1.
"""

from __future__ import annotations

import re
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

UNFOLD = {"spark": {"twice": "explode(array(1, 2))", "thrice": "explode(array(1, 2, 3))"},
          "duckdb": {"twice": "unnest([1, 2])", "thrice": "unnest([1, 2, 3])"}}

# ---- typed schedule tables ---------------------------------------------------------

SCHEDULE = {
    "versions": """
SELECT version_id, version_name, CAST(created_at AS TIMESTAMP) AS created_at,
       CAST(updated_at AS TIMESTAMP) AS updated_at, is_active
FROM (VALUES (1,'gtfs_2023-11-01_00:00:00','2023-11-01 01:00:00','2023-11-01 00:00:00',false),
             (2,'gtfs_2024-01-01_00:00:00','2024-01-01 01:00:00','2024-01-01 00:00:00',true),
             (3,'gtfs_2023-09-01_00:00:00','2023-09-01 01:00:00','2023-09-01 00:00:00',false),
             (4,'gtfs_2023-10-01_00:00:00','2023-10-01 01:00:00','2023-10-01 00:00:00',false))
     AS t(version_id, version_name, created_at, updated_at, is_active)""",
    "agency": """
SELECT 'A' || CAST(r_regionkey AS STRING) AS agency_id, source_id, version_id, r_name AS agency_name,
       'Australia/Melbourne' AS agency_timezone
FROM (SELECT *, {twice} AS version_id FROM (SELECT *, {twice} AS source_id FROM {region}) AS a) AS b""",
    "routes": """
SELECT 'R' || CAST(n_nationkey AS STRING) AS route_id, source_id, version_id,
       'A' || CAST(n_regionkey AS STRING) AS agency_id,
       CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE CAST(n_nationkey AS STRING) END AS route_short_name,
       n_name AS route_long_name, n_nationkey % 4 AS route_type,
       '00AAFF' AS route_color, 'FFFFFF' AS route_text_color
FROM (SELECT *, {twice} AS version_id FROM (SELECT *, {twice} AS source_id FROM {nation}) AS a) AS b""",
    "stops": """
SELECT 'S' || CAST(s_suppkey AS STRING) AS stop_id, source_id, version_id, s_name AS stop_name,
       -38e0 + CAST(s_suppkey * 37 % 100 AS DOUBLE) / 100e0 AS stop_lat,
       144.5e0 + CAST(s_suppkey * 53 % 100 AS DOUBLE) / 100e0 AS stop_lon,
       CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS location_type,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL
            ELSE 'S' || CAST(s_suppkey - s_suppkey % 5 AS STRING) END AS parent_station
FROM (SELECT *, {twice} AS version_id FROM (SELECT *, {twice} AS source_id FROM {supplier}) AS a) AS b""",
    "platform_numbers": """
SELECT 'S' || CAST(s_suppkey AS STRING) AS platform_id, CAST(s_suppkey % 5 AS STRING) AS platform_number
FROM {supplier} WHERE s_suppkey % 5 IN (1, 2)""",
    "calendar": """
SELECT 'C' || CAST(c_custkey AS STRING) AS service_id, source_id, version_id,
       CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS monday, CAST(c_custkey % 2 AS INT) AS tuesday,
       1 AS wednesday, 1 AS thursday, 1 AS friday,
       CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS saturday,
       CASE WHEN c_custkey % 5 < 2 THEN 1 ELSE 0 END AS sunday,
       CAST(CASE WHEN c_custkey % 7 = 0 THEN '2024-01-16' ELSE '2023-12-01' END AS DATE) AS start_date,
       CAST(CASE WHEN c_custkey % 11 = 0 THEN '2024-01-10' ELSE '2024-06-30' END AS DATE) AS end_date
FROM (SELECT *, {twice} AS version_id FROM (SELECT *, {twice} AS source_id FROM {customer}) AS a) AS b""",
    "calendar_dates": """
SELECT 'C' || CAST(c_custkey AS STRING) AS service_id, source_id, version_id,
       CAST(CASE WHEN c_custkey % 2 = 0 THEN '2024-01-15' ELSE '2024-01-14' END AS DATE) AS date,
       CASE WHEN c_custkey % 10 < 5 THEN 1 ELSE 2 END AS exception_type
FROM (SELECT *, {twice} AS version_id FROM (SELECT *, {twice} AS source_id FROM {customer}) AS a) AS b
WHERE c_custkey % 4 IN (0, 1)""",
    "trips": """
SELECT 'T' || CAST(o_orderkey AS STRING) AS trip_id, source_id, version_id,
       'R' || CAST(c_nationkey AS STRING) AS route_id, 'C' || CAST(o_custkey AS STRING) AS service_id,
       o_orderpriority AS trip_headsign, CAST(o_orderkey % 2 AS INT) AS direction_id
FROM (SELECT *, CAST(o_orderkey % 2 + 1 AS INT) AS source_id, {twice} AS version_id FROM {orders}) AS o
JOIN {customer} AS c ON o_custkey = c_custkey
WHERE version_id = 2 OR o_orderkey % 3 = 0""",
    "stop_times": """
SELECT 'T' || CAST(l_orderkey AS STRING) AS trip_id, CAST(l_orderkey % 2 + 1 AS INT) AS source_id,
       version_id, 'S' || CAST(supp AS STRING) AS stop_id, l_linenumber AS stop_sequence,
       CAST(l_orderkey * 971 % 90000 + l_linenumber * 300 AS INT) AS arrival_time_seconds,
       CAST(l_orderkey * 971 % 90000 + l_linenumber * 300 + 30 AS INT) AS departure_time_seconds,
       CASE WHEN l_linenumber % 4 = 0 THEN 'via city' ELSE NULL END AS stop_headsign,
       CAST(l_orderkey % 2 AS INT) AS pickup_type, 0 AS drop_off_type
FROM (SELECT *, {twice} AS version_id
      FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS supp
            FROM {lineitem} GROUP BY l_orderkey, l_linenumber) AS g) AS l
WHERE version_id = 2 OR l_orderkey % 3 = 0""",
}

# ---- a log of versions and portal answers, as long as the order book -----------------

LOGS = {
    "version_log": """
SELECT CAST(o_orderkey AS INT) AS version_id, 'v' || CAST(o_orderkey AS STRING) AS version_name,
       o_orderdate AS created_at, o_orderdate AS updated_at, o_orderkey = 7 AS is_active
FROM {orders}""",
    "portal_text": """
SELECT o_orderkey, o_orderkey % 5 <> 0 AS success,
       CASE WHEN o_orderkey % 6 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T08:30:15.250000'
            WHEN o_orderkey % 6 = 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T23:59:59'
            WHEN o_orderkey % 6 = 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T08:30:15Z'
            WHEN o_orderkey % 6 = 3 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T08:30:15.5+10:00'
            WHEN o_orderkey % 6 = 4 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T08:30:15-04:30'
            ELSE 'some day' END AS last_modified,
       'https://portal.example/dataset/' || CAST(o_custkey AS STRING) || '/resource/'
           || CAST(o_orderkey AS STRING) AS url
FROM {orders}""",
    "old_sources": """
SELECT CAST(p_partkey AS INT) AS source_id, p_name AS source_name FROM {part}""",
    "new_sources": """
SELECT CAST(c_custkey AS INT) * 2 AS source_id, c_name AS source_name FROM {customer}""",
}

# ---- schedule files: text cells, some of them odd -------------------------------------

RAW = {
    "raw_agency": """
SELECT 'A' || CAST(n_nationkey AS STRING) AS agency_id, n_name AS agency_name,
       CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE ' http://agency.example/' || n_name END AS agency_url,
       'Australia/Melbourne ' AS agency_timezone,
       CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 'en' END AS agency_lang,
       CASE WHEN n_nationkey % 5 = 0 THEN '  ' ELSE 'http://fares.example' END AS agency_fare_url,
       source_id
FROM (SELECT *, {twice} AS source_id FROM {nation}) AS n""",
    "raw_levels": """
SELECT 'L' || CAST(p_partkey AS STRING) AS level_id,
       CASE WHEN p_size % 9 = 0 THEN 'ground' WHEN p_size % 9 = 1 THEN ''
            ELSE CAST(p_size % 5 - 2 AS STRING) || '.5e0' END AS level_index,
       CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS level_name, source_id
FROM (SELECT *, {twice} AS source_id FROM {part}) AS p""",
    "raw_stops": """
SELECT 'S' || CAST(s_suppkey AS STRING) AS stop_id, s_name AS stop_name,
       CASE WHEN s_suppkey % 10 = 0 THEN '0' WHEN s_suppkey % 10 = 1 THEN 'north'
            WHEN s_suppkey % 10 = 2 THEN ''
            ELSE ' -37.' || CAST(100000 + s_suppkey * 7919 % 900000 AS STRING) END AS stop_lat,
       '144.' || CAST(100000 + s_suppkey * 6151 % 900000 AS STRING) AS stop_lon,
       CASE WHEN s_suppkey % 6 = 0 THEN '1' WHEN s_suppkey % 6 = 1 THEN ''
            WHEN s_suppkey % 6 = 2 THEN 'x' WHEN s_suppkey % 6 = 3 THEN '7' ELSE '0' END AS location_type,
       CASE WHEN s_suppkey % 5 = 0 THEN '' WHEN s_suppkey % 17 = 0 THEN 'S99999999'
            ELSE 'S' || CAST(s_suppkey - s_suppkey % 5 AS STRING) END AS parent_station,
       CAST(s_suppkey % 4 AS STRING) AS wheelchair_boarding,
       CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'L' || CAST(s_suppkey % 700 AS STRING) END AS level_id,
       source_id
FROM (SELECT *, {twice} AS source_id FROM {supplier}) AS s""",
    "raw_routes": """
SELECT 'R' || CAST(p_partkey AS STRING) AS route_id,
       CASE WHEN p_partkey % 8 = 0 THEN '' ELSE 'A' || CAST(p_partkey % 27 AS STRING) END AS agency_id,
       CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE CAST(p_size AS STRING) END AS route_short_name,
       p_name AS route_long_name,
       CASE WHEN p_size % 7 = 0 THEN '3.0' ELSE CAST(p_size % 4 AS STRING) END AS route_type,
       CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN '#00AAFF' ELSE '00AAFF' END
           AS route_color,
       'FFFFFF' AS route_text_color, source_id
FROM (SELECT *, {twice} AS source_id FROM {part}) AS p""",
    "raw_calendar": """
SELECT 'C' || CAST(c_custkey AS STRING) AS service_id, CAST(c_custkey % 2 AS STRING) AS monday,
       CASE WHEN c_custkey % 5 = 0 THEN 'yes' ELSE '1' END AS tuesday, '1' AS wednesday, '1' AS thursday,
       '+1' AS friday, CASE WHEN c_custkey % 9 = 0 THEN '2' ELSE '0' END AS saturday, '' AS sunday,
       CASE WHEN c_custkey % 13 = 0 THEN '2024-01-01' ELSE '20240101' END AS start_date,
       CASE WHEN c_custkey % 17 = 0 THEN '20240230' WHEN c_custkey % 19 = 0 THEN ''
            ELSE '20241231' END AS end_date, source_id
FROM (SELECT *, {twice} AS source_id FROM {customer}) AS c""",
    "raw_calendar_dates": """
SELECT 'C' || CAST(o_custkey AS STRING) AS service_id,
       CASE WHEN o_orderkey % 23 = 0 THEN '20249999' WHEN o_orderkey % 29 = 0 THEN NULL
            ELSE '202401' || LPAD(CAST(o_orderkey % 28 + 1 AS STRING), 2, '0') END AS date,
       CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE CAST(o_orderkey % 2 + 1 AS STRING) END AS exception_type,
       CAST(o_orderkey % 2 + 1 AS INT) AS source_id
FROM {orders}""",
    "raw_shapes": """
SELECT 'H' || CAST(l_orderkey AS STRING) AS shape_id,
       '-37.' || CAST(100000 + l_partkey * 7919 % 900000 AS STRING) AS shape_pt_lat,
       CASE WHEN l_linenumber = 3 THEN 'east' ELSE '144.' || CAST(100000 + l_partkey * 6151 % 900000 AS STRING) END
           AS shape_pt_lon,
       CAST(l_linenumber AS STRING) AS shape_pt_sequence,
       CASE WHEN l_linenumber = 1 THEN '0' ELSE CAST(CAST(l_quantity AS INT) AS STRING) || '.25' END
           AS shape_dist_traveled,
       CAST(l_orderkey % 2 + 1 AS INT) AS source_id
FROM {lineitem}""",
    "raw_trips": """
SELECT 'T' || CAST(o_orderkey AS STRING) AS trip_id, 'R' || CAST(o_orderkey % 2500 AS STRING) AS route_id,
       'C' || CAST(o_custkey * 2 AS STRING) AS service_id,
       CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'H' || CAST(o_orderkey AS STRING) END AS shape_id,
       CASE WHEN o_orderkey % 6 = 0 THEN '  ' ELSE o_orderpriority END AS trip_headsign,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '2'
            ELSE CAST(o_orderkey % 2 AS STRING) END AS direction_id,
       CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'B' || CAST(o_orderkey % 50 AS STRING) END AS block_id,
       CAST(o_orderkey % 4 AS STRING) AS wheelchair_accessible,
       CAST(o_orderkey % 2 + 1 AS INT) AS source_id
FROM {orders}""",
    "raw_stop_times": """
SELECT 'T' || CAST(l_orderkey AS STRING) AS trip_id, 'S' || CAST(l_suppkey AS STRING) AS stop_id,
       CASE WHEN l_orderkey % 37 = 0 THEN 'first' ELSE CAST(l_linenumber AS STRING) END AS stop_sequence,
       CASE WHEN l_orderkey % 11 = 0 THEN '' WHEN l_orderkey % 13 = 0 THEN 'aa:00:00'
            WHEN l_orderkey % 17 = 0 THEN '7:5' WHEN l_orderkey % 19 = 0 THEN '-1:30:00'
            WHEN l_orderkey % 23 = 0 THEN '+25:61:00' WHEN l_orderkey % 29 = 0 THEN '7: 5:00'
            ELSE ' ' || CAST(l_orderkey * 971 % 30 AS STRING) || ':'
                 || LPAD(CAST(l_linenumber * 7 AS STRING), 2, '0') || ':' || CAST(l_orderkey % 60 AS STRING) || ' '
            END AS arrival_time,
       CAST(l_orderkey * 971 % 30 AS STRING) || ':' || LPAD(CAST(l_linenumber * 7 AS STRING), 2, '0') || ':30'
           AS departure_time,
       CASE WHEN l_linenumber % 4 = 0 THEN 'via "city", loop'
            WHEN l_linenumber % 4 = 1 AND l_orderkey % 2 = 1 THEN 'two' || chr(10) || 'lines'
            WHEN l_linenumber % 4 = 2 THEN '' ELSE NULL END AS stop_headsign,
       CAST(l_orderkey % 5 AS STRING) AS pickup_type, '0' AS drop_off_type,
       CASE WHEN l_linenumber = 1 THEN '0' ELSE CAST(CAST(l_quantity AS INT) AS STRING) || '.25' END
           AS shape_dist_traveled,
       CAST(l_orderkey % 2 + 1 AS INT) AS source_id
FROM {lineitem}""",
    "raw_pathways": """
SELECT 'P' || CAST(s_suppkey AS STRING) AS pathway_id, 'S' || CAST(s_suppkey AS STRING) AS from_stop_id,
       'S' || CAST(s_suppkey * 3 % 120 AS STRING) AS to_stop_id, CAST(s_suppkey % 9 AS STRING) AS pathway_mode,
       CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '1' END AS is_bidirectional,
       CAST(s_suppkey % 4 * 30 AS STRING) AS traversal_time, source_id
FROM (SELECT *, {twice} AS source_id FROM {supplier}) AS s""",
    "raw_transfers": """
SELECT 'S' || CAST(o_custkey % 130 AS STRING) AS from_stop_id, 'S' || CAST(o_orderkey % 90 AS STRING) AS to_stop_id,
       CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'R' || CAST(o_orderkey % 210 AS STRING) END AS from_route_id,
       CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE 'R' || CAST(o_orderkey % 190 AS STRING) END AS to_route_id,
       CASE WHEN o_orderkey % 4 = 0 THEN 'T' || CAST(o_orderkey AS STRING) ELSE '' END AS from_trip_id,
       CASE WHEN o_orderkey % 8 = 0 THEN 'T' || CAST(o_orderkey + 1 AS STRING) ELSE NULL END AS to_trip_id,
       CAST(o_orderkey % 6 AS STRING) AS transfer_type, CAST(o_orderkey % 3 * 60 AS STRING) AS min_transfer_time,
       CAST(o_orderkey % 2 + 1 AS INT) AS source_id
FROM {orders}""",
}

# ---- realtime tables -------------------------------------------------------------------

LIVE = {
    "fx_ev": """
SELECT event_id, ts, user_id, event_type, value, event_id - event_id % 20 AS feed_message_id,
       CAST((event_id - event_id % 20) % 3 AS INT) AS kind, CAST((event_id - event_id % 20) % 40 AS INT) AS half
FROM {events}""",
    "feed_messages": """
SELECT feed_message_id, min(ts) AS timestamp, max(ts) AS received_at,
       CASE WHEN half = 0 THEN 1 ELSE 2 END AS source_id, 2 AS version_id,
       CASE WHEN kind = 0 THEN 'vehicle_positions' WHEN kind = 1 THEN 'trip_updates'
            ELSE 'service_alerts' END AS feed_type,
       0 AS incrementality, '2.0' AS gtfs_realtime_version
FROM {fx_ev} GROUP BY feed_message_id, half, kind""",
    "vehicle_positions": """
SELECT event_id AS vehicle_position_id, feed_message_id, 'E' || CAST(event_id AS STRING) AS entity_id,
       'T' || CAST(event_id * 13 % 1000 AS STRING) AS trip_id, 'R' || CAST(user_id % 25 AS STRING) AS route_id,
       CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'V' || CAST(user_id AS STRING) END AS vehicle_id,
       CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'Tram ' || CAST(user_id AS STRING) END AS vehicle_label,
       -38e0 + CAST(event_id * 37 % 100 AS DOUBLE) / 100e0 AS latitude,
       144.5e0 + CAST(event_id * 53 % 100 AS DOUBLE) / 100e0 AS longitude,
       CAST(event_id % 360 AS INT) AS bearing, CAST(event_id % 3 AS INT) AS current_status,
       CASE WHEN event_type = 'view' THEN NULL ELSE 'S' || CAST(user_id % 10 AS STRING) END AS stop_id,
       CAST(event_id % 4 AS INT) AS schedule_relationship, ts AS timestamp
FROM {fx_ev} WHERE kind = 0""",
    "trip_updates": """
SELECT event_id AS trip_update_id, feed_message_id, 'E' || CAST(event_id AS STRING) AS entity_id,
       'T' || CAST(event_id * 13 % 1000 AS STRING) AS trip_id, 'R' || CAST(user_id % 25 AS STRING) AS route_id,
       CAST(CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '2024-01-14' WHEN 2 THEN '2023-12-01'
            ELSE '2024-01-15' END AS DATE) AS start_date,
       CAST(event_id % 4 AS INT) AS schedule_relationship,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS timestamp,
       CAST(event_id * 31 % 900 - 120 AS INT) AS delay
FROM {fx_ev} WHERE kind = 1""",
    "stop_time_updates": """
SELECT trip_update_id * 10 + n AS stop_time_update_id, trip_update_id,
       CASE WHEN trip_update_id % 4 = 1 THEN -1 ELSE n END AS stop_sequence,
       'S' || CAST((trip_update_id + n) % 10 AS STRING) AS stop_id,
       CAST(trip_update_id * 31 % 900 - 120 + n AS INT) AS arrival_delay,
       CASE WHEN trip_update_id % 6 = 0 THEN NULL ELSE 1704067200 + trip_update_id * 60 END AS arrival_time,
       CASE WHEN trip_update_id % 9 = 0 THEN NULL ELSE CAST(trip_update_id * 31 % 900 - 90 AS INT) END AS departure_delay,
       CASE WHEN trip_update_id % 5 = 0 THEN NULL ELSE 1704067260 + trip_update_id * 60 END AS departure_time,
       0 AS schedule_relationship
FROM (SELECT *, {twice} AS n FROM {trip_updates}) AS u WHERE n <= trip_update_id % 3""",
    "alerts": """
SELECT event_id AS alert_id, feed_message_id, 'E' || CAST(event_id AS STRING) AS entity_id,
       CAST(event_id % 12 AS INT) + 1 AS cause, CAST(event_id % 11 AS INT) + 1 AS effect,
       CAST(event_id % 4 AS INT) + 1 AS severity
FROM {fx_ev} WHERE kind = 2""",
    "alert_active_periods": """
SELECT alert_id, 1704067200 + alert_id * 7919 % 864000 AS start_time,
       CASE WHEN (alert_id + n) % 5 = 0 THEN NULL
            ELSE 1704067200 + (alert_id * 7919 + n * 400000) % 2592000 END AS end_time
FROM (SELECT *, {twice} AS n FROM {alerts}) AS a WHERE n <= alert_id % 3""",
    "alert_informed_entities": """
SELECT alert_id, 'A' || CAST(alert_id % 5 AS STRING) AS agency_id,
       CASE WHEN n = 3 THEN NULL ELSE 'R' || CAST(alert_id % 25 AS STRING) END AS route_id,
       CASE WHEN n = 1 THEN NULL ELSE 'S' || CAST(alert_id % 10 AS STRING) END AS stop_id
FROM (SELECT *, {thrice} AS n FROM {alerts}) AS a""",
    "alert_translations": """
SELECT alert_id, CASE WHEN n = 1 THEN 'header_text' ELSE 'description_text' END AS field_type,
       CASE WHEN alert_id % 2 = 0 THEN '' ELSE 'en' END AS language,
       'Works on route ' || CAST(alert_id % 25 AS STRING) AS text
FROM (SELECT *, {twice} AS n FROM {alerts}) AS a""",
}

# ---- names with a kind and a rare word, and as many texts that misspell them ------

NAMES = {
    "place_names": """
SELECT c_custkey, p_name || ' ' || substr(md5(c_name), 1, 12) AS place_name
FROM {customer} AS c JOIN {part} AS p ON p_partkey = c_custkey""",
    "misspelt": """
SELECT c_custkey AS text_id, CASE WHEN c_custkey % 3 = 0 THEN replace(place_name, 'i', 'y')
    WHEN c_custkey % 3 = 1 THEN upper(substr(place_name, 1, 3) || substr(place_name, 5))
    ELSE place_name || 'x' END AS wanted
FROM {place_names}""",
}

DERIVED = {**SCHEDULE, **LOGS, **RAW, **LIVE, **NAMES}


def references(text: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{([a-z]\w*)\}", text)) if n not in UNFOLD["spark"]]


class Tables(dict):
    """Given and derived tables by name, defined when first asked for.

    These are definitions only; no rows are kept between queries.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Tables:
        """The tables of a folder, defined once per session as a user would."""
        defined = _DEFINED.setdefault(spark, {})
        if sf_dir not in defined:
            defined[sf_dir] = cls(spark, sf_dir)
        return defined[sf_dir]

    def __missing__(self, name: str) -> DataFrame:
        if name in DERIVED:
            text = DERIVED[name]
            needs = references(text)
            for macro, sql in UNFOLD["spark"].items():
                text = text.replace("{%s}" % macro, sql)
            frame = self.spark.sql(text, **{n: self[n] for n in needs})
        else:
            frame = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
            for field in frame.schema:
                # Stamps are stored without a zone and meant as UTC, the session zone.
                if field.dataType.typeName() == "timestamp_ntz":
                    frame = frame.withColumn(field.name, F.col(field.name).cast("timestamp"))
        self[name] = frame
        return frame

    def pick(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}


_DEFINED: WeakKeyDictionary[SparkSession, dict[str, Tables]] = WeakKeyDictionary()


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` for the check engine, led by the derived tables it needs.

    Tables are named ``{like_this}`` in ``sql`` as well.
    """
    texts = {**DERIVED, **(extra or {})}
    wanted: dict[str, str] = {}

    def need(text: str) -> None:
        for name in references(text):
            if name in texts and name not in wanted:
                need(texts[name])
                wanted[name] = texts[name]

    need(sql)

    def plain(text: str) -> str:
        for macro, form in UNFOLD["duckdb"].items():
            text = text.replace("{%s}" % macro, form)
        return re.sub(r"\{([a-z]\w*)\}", r"\1", text)

    ctes = ",\n".join(f"{n} AS ({plain(t).strip()})" for n, t in wanted.items())
    body = plain(sql).strip()
    if ctes and body.startswith("WITH"):
        body = f"SELECT * FROM ({body}) AS result"
    return (f"WITH {ctes}\n" if ctes else "") + body
