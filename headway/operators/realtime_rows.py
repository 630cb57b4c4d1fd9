"""Nested realtime messages flattened to relational rows.

Input is the frame ``tag_messages`` returns. Ids of parents are built from the columns that
identify them (message key, entity id), so children carry them without any lookup join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway import schemas as S
from headway.functions.clocks import gtfs_date, gtfs_time_to_seconds, posix_to_timestamp


def entity_key(feed_message_id: Column, entity_id: Column) -> Column:
    """Stable id of one entity of one message."""
    return F.concat_ws(":", feed_message_id, entity_id)


def _message_time() -> Column:
    return F.coalesce(posix_to_timestamp(F.col("message.header.timestamp")), "received_at")


def feed_messages(tagged: DataFrame) -> DataFrame:
    """One row per message of a known feed type."""
    h = F.col("message.header")
    return (tagged.where(F.col("feed_type").isin(S.FEED_TYPES) & h.isNotNull())
            .select("feed_message_id", _message_time().alias("timestamp"),
                    h["gtfs_realtime_version"].alias("gtfs_realtime_version"),
                    F.when(h["incrementality"] == "DIFFERENTIAL", 1).otherwise(0)
                    .alias("incrementality"),
                    "received_at", "source_id", "version_id", "feed_type"))


def _entities(tagged: DataFrame, feed_type: str) -> DataFrame:
    """The entities of the messages of one type; a message without any gives a row without one.

    The outer form keeps Spark from testing the list for entities first, which would build all
    of them once more for the test. Every table asks for a part of the entity, so rows without
    one go there.
    """
    return (tagged.where((F.col("feed_type") == feed_type)
                         & F.col("message.header").isNotNull())
            .select("feed_message_id", "received_at", "source_id", "version_id",
                    _message_time().alias("feed_time"), F.explode_outer("message.entity").alias("e")))


def _trip_start(trip: Column) -> tuple[Column, Column]:
    return gtfs_time_to_seconds(trip["start_time"]), gtfs_date(trip["start_date"])


def vehicle_positions(tagged: DataFrame, *more: str) -> DataFrame:
    """One row per entity with a vehicle that has a position; a number out of its column's range
    is NULL, so that one bad entity cannot end a stream. ``more`` are columns of the message."""
    v = F.col("e.vehicle")
    trip, unit, at = v["trip"], v["vehicle"], v["position"]
    start_time, start_date = _trip_start(trip)
    return (_entities(tagged, "vehicle_positions")
            .where(v.isNotNull() & at.isNotNull())
            .select(entity_key(F.col("feed_message_id"), F.col("e.id")).alias("vehicle_position_id"),
                    "feed_message_id", F.col("e.id").alias("entity_id"),
                    F.col("e.is_deleted").alias("is_deleted"),
                    trip["trip_id"].alias("trip_id"), trip["route_id"].alias("route_id"),
                    start_time.alias("start_time"), start_date.alias("start_date"),
                    trip["schedule_relationship"].alias("schedule_relationship"),
                    unit["id"].alias("vehicle_id"), unit["label"].alias("vehicle_label"),
                    unit["license_plate"].alias("license_plate"),
                    at["latitude"].cast("double").try_cast(S.COORD).alias("latitude"),
                    at["longitude"].cast("double").try_cast(S.COORD).alias("longitude"),
                    at["bearing"].cast("double").try_cast(S.ANGLE).alias("bearing"),
                    v["current_status"].alias("current_status"), v["stop_id"].alias("stop_id"),
                    F.coalesce(posix_to_timestamp(v["timestamp"]), "received_at")
                    .alias("timestamp"), *more))


def _trip_update_entities(tagged: DataFrame) -> DataFrame:
    return (_entities(tagged, "trip_updates").where(F.col("e.trip_update.trip.trip_id").isNotNull())
            .withColumn("trip_update_id", entity_key(F.col("feed_message_id"), F.col("e.id"))))


def trip_updates(tagged: DataFrame) -> DataFrame:
    """One row per entity with a trip update that names its trip."""
    u = F.col("e.trip_update")
    trip, unit = u["trip"], u["vehicle"]
    start_time, start_date = _trip_start(trip)
    return _trip_update_entities(tagged).select(
        "trip_update_id", "feed_message_id", F.col("e.id").alias("entity_id"),
        F.col("e.is_deleted").alias("is_deleted"), trip["trip_id"].alias("trip_id"),
        trip["route_id"].alias("route_id"), trip["direction_id"].alias("direction_id"),
        start_time.alias("start_time"), start_date.alias("start_date"),
        trip["schedule_relationship"].alias("schedule_relationship"),
        unit["id"].alias("vehicle_id"), unit["label"].alias("vehicle_label"),
        posix_to_timestamp(u["timestamp"]).alias("timestamp"), u["delay"].alias("delay"))


def _updates(tagged: DataFrame) -> DataFrame:
    trip = F.col("e.trip_update.trip")
    return _trip_update_entities(tagged).select(
        "trip_update_id", "feed_message_id", "source_id", "version_id", "feed_time",
        trip["trip_id"].alias("trip_id"), trip["route_id"].alias("route_id"),
        F.explode("e.trip_update.stop_time_update").alias("s"))


def stop_time_updates(tagged: DataFrame, *more: str) -> DataFrame:
    """One row per stop of a trip update; sequence and stop take their declared defaults.
    ``more`` are columns of the message and the trip."""
    s = F.col("s")
    return _updates(tagged).select(
        "trip_update_id",
        F.coalesce(s["stop_sequence"], F.lit(-1)).alias("stop_sequence"),
        F.coalesce(s["stop_id"], F.lit("")).alias("stop_id"),
        s["arrival"]["delay"].alias("arrival_delay"), s["arrival"]["time"].alias("arrival_time"),
        s["arrival"]["uncertainty"].alias("arrival_uncertainty"),
        s["departure"]["delay"].alias("departure_delay"),
        s["departure"]["time"].alias("departure_time"),
        s["departure"]["uncertainty"].alias("departure_uncertainty"),
        s["schedule_relationship"].alias("schedule_relationship"), *more)


def affected_stops(tagged: DataFrame) -> DataFrame:
    """Distinct stops named by each message's trip updates."""
    return (_updates(tagged).where("s.stop_id is not null")
            .select("feed_message_id", F.col("s.stop_id").alias("stop_id")).distinct())


def _alert_entities(tagged: DataFrame) -> DataFrame:
    return (_entities(tagged, "service_alerts").where("e.alert is not null")
            .withColumn("alert_id", entity_key(F.col("feed_message_id"), F.col("e.id"))))


def alerts(tagged: DataFrame, *more: str) -> DataFrame:
    """One row per entity with an alert. ``more`` are columns of the message."""
    a = F.col("e.alert")
    return _alert_entities(tagged).select(
        "alert_id", "feed_message_id", F.col("e.id").alias("entity_id"),
        F.col("e.is_deleted").alias("is_deleted"), a["cause"].alias("cause"),
        a["effect"].alias("effect"), a["severity_level"].alias("severity"), *more)


def alert_selectors(tagged: DataFrame) -> DataFrame:
    """One row per distinct (route, stop, agency) an alert names, with the alert's facts; they
    are told apart inside the alert, so nothing is shuffled."""
    named = F.transform("e.alert.informed_entity",
                        lambda i: F.struct(i["route_id"], i["stop_id"], i["agency_id"]))
    return (_alert_entities(tagged)
            .select("alert_id", "source_id", "feed_time", "e.alert.cause", "e.alert.effect",
                    F.col("e.alert.severity_level").alias("severity"),
                    F.inline(F.array_distinct(named)).alias("route_id", "stop_id", "agency_id")))


def alert_active_periods(tagged: DataFrame) -> DataFrame:
    """One row per period; either end may be open."""
    return (_alert_entities(tagged)
            .select("alert_id", F.explode("e.alert.active_period").alias("p"))
            .select("alert_id", F.col("p.start").alias("start_time"),
                    F.col("p.end").alias("end_time")))


def alert_informed_entities(tagged: DataFrame) -> DataFrame:
    """One row per selector, its trip flattened."""
    i = F.col("i")
    start_time, start_date = _trip_start(i["trip"])
    return (_alert_entities(tagged)
            .select("alert_id", F.explode("e.alert.informed_entity").alias("i"))
            .select("alert_id", i["agency_id"].alias("agency_id"), i["route_id"].alias("route_id"),
                    i["direction_id"].alias("direction_id"), i["trip"]["trip_id"].alias("trip_id"),
                    i["trip"]["route_id"].alias("trip_route_id"),
                    start_time.alias("trip_start_time"), start_date.alias("trip_start_date"),
                    i["stop_id"].alias("stop_id")))


def alert_translations(tagged: DataFrame) -> DataFrame:
    """One row per text of each of the three text fields; no language is an empty one."""
    fields = F.array(*[
        F.struct(F.lit(name).alias("field_type"),
                 F.col(f"e.alert.{name}.translation").alias("translation"))
        for name in ("url", "header_text", "description_text")])
    return (_alert_entities(tagged)
            .select("alert_id", F.explode(fields).alias("f"))
            .select("alert_id", "f.field_type", F.explode("f.translation").alias("t"))
            .select("alert_id", "field_type",
                    F.coalesce("t.language", F.lit("")).alias("language"),
                    F.col("t.text").alias("text")))


def parent_keys(tagged: DataFrame) -> DataFrame:
    """(message, entity id) → parent id, for every parent row of the messages."""
    pairs = [(_trip_update_entities(tagged), "trip_update_id"), (_alert_entities(tagged), "alert_id")]
    first, second = [
        df.select("feed_message_id", F.col("e.id").alias("entity_id"),
                  F.col(key).alias("parent_id")) for df, key in pairs]
    return first.unionByName(second)


PARENTS = {"feed_messages": feed_messages, "vehicle_positions": vehicle_positions,
           "trip_updates": trip_updates, "alerts": alerts}
CHILDREN = {"stop_time_updates": stop_time_updates,
            "alert_active_periods": alert_active_periods,
            "alert_informed_entities": alert_informed_entities,
            "alert_translations": alert_translations}
REALTIME_ROWS = {**PARENTS, **CHILDREN}
