"""Change events: one (channel, payload, event_time) row per notification.

Each function takes rows that carry what they need of their message: stored rows are joined to it
(``with_feed``, ``with_trip_update``, ``with_alert``), once however many kinds of event they yield;
rows of nested messages have it at hand (``message_events``).

Fixed values: channel prefixes and the names and order of payload members are the subscribers'.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.clocks import AsOf, instant, iso_utc
from headway.functions.texts import channel, json_payload
from headway.operators import realtime_rows as R
from headway.operators.parents import parent_key, to_parent

# Fixed value: rows are only ever appended.
OPERATION = "INSERT"


def with_feed(rows: DataFrame, feed_messages: DataFrame) -> DataFrame:
    """Rows with their message's source, version and time (``feed_time``)."""
    return to_parent(rows, feed_messages, "feed_message_id", "source_id", "version_id",
                     F.col("timestamp").alias("feed_time"))


def with_trip_update(stop_time_updates: DataFrame, trip_updates: DataFrame,
                     feed_messages: DataFrame) -> DataFrame:
    """Stop rows with their trip and message."""
    rows = to_parent(stop_time_updates, trip_updates, "trip_update_id", "feed_message_id",
                     "trip_id", "route_id")
    return with_feed(rows, feed_messages)


def _cols(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _events(rows: DataFrame, to: Column, payload: Column, at: Column) -> DataFrame:
    return rows.select(to.alias("channel"), payload.alias("payload"), at.alias("event_time"))


def _stamp() -> dict[str, Column]:
    return {"timestamp": iso_utc(F.col("feed_time"))}


def stop_departure_events(updates: DataFrame) -> DataFrame:
    payload = json_payload(
        type=F.lit("update"),
        **_cols("source_id", "stop_id", "trip_id", "route_id", "arrival_delay",
                "departure_delay", "arrival_time", "departure_time", "schedule_relationship"),
        **_stamp(), operation=F.lit(OPERATION))
    return _events(updates, channel("stop_departures", F.col("source_id"), F.col("stop_id")),
                   payload, F.col("feed_time"))


def vehicle_position_events(positions: DataFrame) -> DataFrame:
    payload = json_payload(
        type=F.lit("vehicle_position"),
        **_cols("entity_id", "trip_id", "route_id", "source_id", "version_id"),
        operation=F.lit(OPERATION), **_stamp(),
        **_cols("vehicle_id", "vehicle_label", "latitude", "longitude", "bearing",
                "current_status", "stop_id", "schedule_relationship"))
    return _events(positions.where("vehicle_id is not null"),
                   channel("vehicle_positions", F.col("source_id"), F.col("vehicle_id")),
                   payload, F.col("feed_time"))


def vehicle_at_stop_events(positions: DataFrame) -> DataFrame:
    payload = json_payload(
        type=F.lit("vehicle_at_stop"),
        **_cols("stop_id", "vehicle_id", "trip_id", "route_id", "current_status"), **_stamp())
    return _events(positions.where("stop_id is not null"),
                   channel("vehicle_at_stop", F.col("source_id"), F.col("stop_id")),
                   payload, F.col("feed_time"))


def alert_events(alerts: DataFrame) -> DataFrame:
    payload = json_payload(
        type=F.lit("service_alert"), **_cols("alert_id", "entity_id", "source_id", "version_id"),
        operation=F.lit(OPERATION), **_stamp(), **_cols("cause", "effect", "severity"))
    return _events(alerts, F.lit("service_alerts_update"), payload, F.col("feed_time"))


def with_alert(selectors: DataFrame, alerts: DataFrame) -> DataFrame:
    """Distinct (route, stop, agency) selectors with the facts of their alert."""
    named = selectors.select(*parent_key(selectors, alerts, "alert_id"),
                             "route_id", "stop_id", "agency_id").distinct()
    return to_parent(named, alerts, "alert_id", "source_id", "cause", "effect", "severity",
                     "feed_time")


def _selector_events(selectors: DataFrame, what: str, prefix: str) -> DataFrame:
    """An event per selector of an alert that names ``what``."""
    payload = json_payload(
        type=F.lit("service_alert"), **_cols("alert_id", what, "cause", "effect", "severity"),
        **_stamp())
    return _events(selectors.where(F.col(what).isNotNull()),
                   channel(prefix, F.col("source_id"), F.col(what)), payload, F.col("feed_time"))


def alert_route_events(selectors: DataFrame) -> DataFrame:
    return _selector_events(selectors, "route_id", "service_alerts_route")


def alert_stop_events(selectors: DataFrame) -> DataFrame:
    return _selector_events(selectors, "stop_id", "service_alerts_stop")


def feed_message_events(feed_messages: DataFrame) -> DataFrame:
    payload = json_payload(
        type=F.lit("feed_update"),
        **_cols("feed_message_id", "source_id", "version_id", "feed_type"),
        operation=F.lit(OPERATION), timestamp=iso_utc(F.col("timestamp")),
        received_at=iso_utc(F.col("received_at")),
        **_cols("gtfs_realtime_version", "incrementality"))
    return _events(feed_messages, channel("feed_messages", F.col("source_id")), payload,
                   F.col("timestamp"))


def _epoch(as_of: AsOf) -> Column:
    return (F.unix_micros(instant(as_of)).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(20,6)")


def trip_events(updates: DataFrame, as_of: AsOf) -> DataFrame:
    """The short payload a subscriber to one trip gets."""
    payload = json_payload(
        **_cols("trip_id", "route_id", "source_id", "stop_id", "departure_delay",
                "arrival_delay", "schedule_relationship"),
        operation=F.lit(OPERATION), timestamp=_epoch(as_of))
    return _events(updates, channel("trip_updates", F.col("trip_id")), payload, instant(as_of))


def trip_batch_events(batches: DataFrame, as_of: AsOf) -> DataFrame:
    """Events of ``trip_update_batch`` rows."""
    payload = json_payload(
        **_cols("trip_id", "route_id", "source_id", "stop_ids", "update_count"),
        operation=F.lit("BATCH_UPDATE"), timestamp=_epoch(as_of))
    return _events(batches, channel("trip_updates", F.col("trip_id")), payload, instant(as_of))


def _every_event(feeds: DataFrame, updates: DataFrame, positions: DataFrame, alerts: DataFrame,
                 selectors: DataFrame, as_of: AsOf) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        feed_message_events(feeds), stop_departure_events(updates), trip_events(updates, as_of),
        vehicle_position_events(positions), vehicle_at_stop_events(positions),
        alert_events(alerts), alert_route_events(selectors), alert_stop_events(selectors)])


def all_events(live: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    """Every event of stored realtime rows, which are joined to their messages."""
    feeds = live["feed_messages"]
    updates = with_trip_update(live["stop_time_updates"], live["trip_updates"], feeds)
    alerts = with_feed(live["alerts"], feeds)
    return _every_event(feeds, updates, with_feed(live["vehicle_positions"], feeds), alerts,
                        with_alert(live["alert_informed_entities"], alerts), as_of)


def message_events(tagged: DataFrame, as_of: AsOf) -> DataFrame:
    """The same events straight from nested messages: each row finds its parents in its own
    message, so there is no join and no shuffle."""
    feed = ("source_id", "version_id", "feed_time")
    return _every_event(R.feed_messages(tagged),
                        R.stop_time_updates(tagged, "trip_id", "route_id", *feed),
                        R.vehicle_positions(tagged, *feed), R.alerts(tagged, *feed),
                        R.alert_selectors(tagged), as_of)
