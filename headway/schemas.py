"""Declared shapes of every table: column types, keys, references and value rules.

Nothing here is inferred from data. Readers and writers use the ``StructType``s,
the quality operators walk the rule tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

STR, INT, LONG, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
DBL, DATE, TS = T.DoubleType(), T.DateType(), T.TimestampType()
COORD, DIST, ANGLE = T.DecimalType(10, 7), T.DecimalType(10, 2), T.DecimalType(5, 2)


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# The zone in which service days and service times are meant.
SERVICE_ZONE = "Australia/Melbourne"

# Weekday flags in calendar order, Monday first.
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

# Every static row belongs to one source within one imported version.
SCOPE = ["source_id", "version_id"]

# Schedule tables in load order, with the columns of each file.
RAW_COLUMNS: dict[str, list[str]] = {
    "agency": ["agency_id", "agency_name", "agency_url", "agency_timezone", "agency_lang",
               "agency_fare_url"],
    "levels": ["level_id", "level_index", "level_name"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "location_type",
              "parent_station", "wheelchair_boarding", "level_id"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type",
               "route_color", "route_text_color"],
    "calendar": ["service_id", *WEEKDAYS, "start_date", "end_date"],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "shapes": ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence",
               "shape_dist_traveled"],
    "trips": ["trip_id", "route_id", "service_id", "shape_id", "trip_headsign",
              "direction_id", "block_id", "wheelchair_accessible"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time",
                   "stop_headsign", "pickup_type", "drop_off_type", "shape_dist_traveled"],
    "pathways": ["pathway_id", "from_stop_id", "to_stop_id", "pathway_mode",
                 "is_bidirectional", "traversal_time"],
    "transfers": ["from_stop_id", "to_stop_id", "from_route_id", "to_route_id",
                  "from_trip_id", "to_trip_id", "transfer_type", "min_transfer_time"],
}
STATIC_TABLES = list(RAW_COLUMNS)

# Realtime tables, parents before children.
REALTIME_TABLES = ["feed_messages", "vehicle_positions", "trip_updates", "stop_time_updates",
                   "alerts", "alert_active_periods", "alert_informed_entities",
                   "alert_translations"]

# Accepted feed types.
FEED_TYPES = ["vehicle_positions", "trip_updates", "service_alerts"]

VERSIONS = _struct(version_id=INT, version_name=STR, created_at=TS, updated_at=TS,
                   is_active=BOOL, source_url=STR, description=STR)

# ---- the nested realtime message -------------------------------------------------

TRIP_REF = _struct(trip_id=STR, route_id=STR, direction_id=INT, start_time=STR,
                   start_date=STR, schedule_relationship=INT)
VEHICLE_REF = _struct(id=STR, label=STR, license_plate=STR)
STOP_EVENT = _struct(delay=INT, time=LONG, uncertainty=INT)
STOP_UPDATE = _struct(stop_sequence=INT, stop_id=STR, arrival=STOP_EVENT,
                      departure=STOP_EVENT, schedule_relationship=INT)
TEXT = _struct(translation=T.ArrayType(_struct(text=STR, language=STR)))
ENTITY = _struct(
    id=STR,
    is_deleted=BOOL,
    trip_update=_struct(trip=TRIP_REF, vehicle=VEHICLE_REF, timestamp=LONG, delay=INT,
                        stop_time_update=T.ArrayType(STOP_UPDATE)),
    vehicle=_struct(trip=TRIP_REF, vehicle=VEHICLE_REF,
                    position=_struct(latitude=T.FloatType(), longitude=T.FloatType(),
                                     bearing=T.FloatType()),
                    current_status=INT, stop_id=STR, timestamp=LONG),
    alert=_struct(active_period=T.ArrayType(_struct(start=LONG, end=LONG)),
                  informed_entity=T.ArrayType(_struct(agency_id=STR, route_id=STR,
                                                      direction_id=INT, trip=TRIP_REF,
                                                      stop_id=STR)),
                  cause=INT, effect=INT, severity_level=INT, url=TEXT, header_text=TEXT,
                  description_text=TEXT),
)
HEADER = _struct(gtfs_realtime_version=STR, incrementality=STR, timestamp=LONG,
                 feed_version=STR)
FEED_MESSAGE = _struct(endpoint=STR, received_at=TS, error=STR,
                       message=_struct(header=HEADER, entity=T.ArrayType(ENTITY)))

PORTAL_RESPONSE = _struct(
    help=STR, success=BOOL,
    result=_struct(id=STR, name=STR, last_modified=STR, format=STR, url=STR,
                   package_id=STR, datastore_active=BOOL))

# ---- rules -----------------------------------------------------------------------

# Identifying columns of each table (static ones also carry SCOPE).
PRIMARY_KEYS: dict[str, list[str]] = {
    "agency": ["agency_id", *SCOPE],
    "calendar": ["service_id", *SCOPE],
    "calendar_dates": ["service_id", *SCOPE, "date"],
    "levels": ["level_id", *SCOPE],
    "stops": ["stop_id", *SCOPE],
    "routes": ["route_id", *SCOPE],
    "shapes": ["shape_id", *SCOPE, "shape_pt_sequence"],
    "trips": ["trip_id", *SCOPE],
    "stop_times": ["trip_id", *SCOPE, "stop_sequence"],
    "pathways": ["pathway_id", *SCOPE],
    "transfers": ["from_stop_id", "to_stop_id", *SCOPE, "from_trip_id", "to_trip_id"],
    "feed_messages": ["received_at", *SCOPE, "feed_type"],
    "vehicle_positions": ["feed_message_id", "entity_id"],
    "trip_updates": ["feed_message_id", "entity_id"],
    "stop_time_updates": ["trip_update_id", "stop_sequence", "stop_id"],
    "alerts": ["feed_message_id", "entity_id"],
}


def _scoped(child: str, column: str, parent: str, key: str):
    return child, [column, *SCOPE], parent, [key, *SCOPE]


# Fixed values: (child, child columns, parent, parent columns).
FOREIGN_KEYS: list[tuple[str, list[str], str, list[str]]] = [
    _scoped("stops", "level_id", "levels", "level_id"),
    _scoped("stops", "parent_station", "stops", "stop_id"),
    _scoped("routes", "agency_id", "agency", "agency_id"),
    _scoped("trips", "route_id", "routes", "route_id"),
    _scoped("stop_times", "trip_id", "trips", "trip_id"),
    _scoped("stop_times", "stop_id", "stops", "stop_id"),
    _scoped("pathways", "from_stop_id", "stops", "stop_id"),
    _scoped("pathways", "to_stop_id", "stops", "stop_id"),
    _scoped("transfers", "from_stop_id", "stops", "stop_id"),
    _scoped("transfers", "to_stop_id", "stops", "stop_id"),
    _scoped("transfers", "from_route_id", "routes", "route_id"),
    _scoped("transfers", "to_route_id", "routes", "route_id"),
    _scoped("transfers", "from_trip_id", "trips", "trip_id"),
    _scoped("transfers", "to_trip_id", "trips", "trip_id"),
    *[(t, ["source_id"], "transport_sources", ["source_id"]) for t in STATIC_TABLES],
    *[(t, ["version_id"], "versions", ["version_id"]) for t in STATIC_TABLES],
    ("feed_messages", ["source_id"], "transport_sources", ["source_id"]),
    ("feed_messages", ["version_id"], "versions", ["version_id"]),
    ("vehicle_positions", ["feed_message_id"], "feed_messages", ["feed_message_id"]),
    ("trip_updates", ["feed_message_id"], "feed_messages", ["feed_message_id"]),
    ("stop_time_updates", ["trip_update_id"], "trip_updates", ["trip_update_id"]),
    ("alerts", ["feed_message_id"], "feed_messages", ["feed_message_id"]),
    ("alert_active_periods", ["alert_id"], "alerts", ["alert_id"]),
    ("alert_informed_entities", ["alert_id"], "alerts", ["alert_id"]),
    ("alert_translations", ["alert_id"], "alerts", ["alert_id"]),
]

# Inclusive ranges a column may take; NULL passes.
VALUE_RANGES: dict[str, dict[str, tuple[int, int]]] = {
    "calendar": {day: (0, 1) for day in WEEKDAYS},
    "calendar_dates": {"exception_type": (1, 2)},
    "stops": {"location_type": (0, 4), "wheelchair_boarding": (0, 2)},
    "trips": {"direction_id": (0, 1), "wheelchair_accessible": (0, 2)},
    "stop_times": {"pickup_type": (0, 3), "drop_off_type": (0, 3)},
    "pathways": {"pathway_mode": (1, 7), "is_bidirectional": (0, 1)},
    "transfers": {"transfer_type": (0, 4)},
}

# Columns that must be filled, and the longest text each may hold.
NOT_NULL: dict[str, list[str]] = {
    "versions": ["version_name", "created_at", "updated_at"],
    "agency": ["agency_id", *SCOPE, "agency_name", "agency_timezone"],
    "calendar": ["service_id", *SCOPE, "start_date", "end_date"],
    "calendar_dates": ["service_id", *SCOPE, "date", "exception_type"],
    "levels": ["level_id", *SCOPE],
    "stops": ["stop_id", *SCOPE, "stop_name"],
    "routes": ["route_id", *SCOPE, "route_type"],
    "shapes": ["shape_id", *SCOPE, "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"],
    "trips": ["trip_id", *SCOPE, "route_id", "service_id"],
    "stop_times": ["trip_id", *SCOPE, "stop_id", "stop_sequence"],
    "pathways": ["pathway_id", *SCOPE, "from_stop_id", "to_stop_id", "pathway_mode"],
    "transfers": ["from_stop_id", "to_stop_id", *SCOPE, "from_trip_id", "to_trip_id"],
    "feed_messages": ["timestamp", "received_at", *SCOPE, "feed_type"],
    "vehicle_positions": ["feed_message_id", "entity_id", "latitude", "longitude", "timestamp"],
    "trip_updates": ["feed_message_id", "entity_id", "trip_id"],
    "stop_time_updates": ["trip_update_id", "stop_sequence", "stop_id"],
    "alerts": ["feed_message_id", "entity_id"],
    "alert_active_periods": ["alert_id"],
    "alert_informed_entities": ["alert_id"],
    "alert_translations": ["alert_id", "field_type", "text"],
}
MAX_LENGTH: dict[str, dict[str, int]] = {
    "versions": {"version_name": 100},
    "agency": {"agency_id": 50, "agency_name": 255, "agency_url": 500, "agency_timezone": 50,
               "agency_lang": 10, "agency_fare_url": 500},
    "calendar": {"service_id": 50},
    "calendar_dates": {"service_id": 50},
    "levels": {"level_id": 50, "level_name": 255},
    "stops": {"stop_id": 50, "stop_name": 255, "parent_station": 50, "level_id": 50},
    "routes": {"route_id": 50, "agency_id": 50, "route_short_name": 50,
               "route_long_name": 255, "route_color": 6, "route_text_color": 6},
    "shapes": {"shape_id": 50},
    "trips": {"trip_id": 100, "route_id": 50, "service_id": 50, "shape_id": 50,
              "trip_headsign": 255, "block_id": 50},
    "stop_times": {"trip_id": 100, "stop_id": 50, "stop_headsign": 255},
    "pathways": {"pathway_id": 50, "from_stop_id": 50, "to_stop_id": 50},
    "transfers": {"from_stop_id": 50, "to_stop_id": 50, "from_route_id": 50,
                  "to_route_id": 50, "from_trip_id": 100, "to_trip_id": 100},
    "feed_messages": {"gtfs_realtime_version": 10, "feed_type": 20},
    "vehicle_positions": {"entity_id": 100, "trip_id": 100, "route_id": 50,
                          "vehicle_id": 100, "vehicle_label": 100, "license_plate": 50,
                          "stop_id": 50},
    "trip_updates": {"entity_id": 100, "trip_id": 100, "route_id": 50, "vehicle_id": 100,
                     "vehicle_label": 100},
    "stop_time_updates": {"stop_id": 50},
    "alerts": {"entity_id": 100},
    "alert_informed_entities": {"agency_id": 50, "route_id": 50, "trip_id": 100,
                                "trip_route_id": 50, "stop_id": 50},
    "alert_translations": {"field_type": 20, "language": 10},
}
