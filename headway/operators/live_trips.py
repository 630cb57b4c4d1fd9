"""Recent realtime facts of trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from headway.functions.clocks import AsOf, instant
from headway.operators.parents import parent_key, to_parent

TripIds = Sequence[str] | DataFrame | None


def _of_trips(trip_updates: DataFrame, trip_ids: TripIds) -> DataFrame:
    """Updates of the asked trips: a short list, a frame with ``trip_id``, or all."""
    if trip_ids is None:
        return trip_updates
    if isinstance(trip_ids, DataFrame):
        return trip_updates.join(trip_ids.select("trip_id"), "trip_id", "left_semi")
    return trip_updates.where(F.col("trip_id").isin(list(trip_ids)))


def _recent(live: dict[str, DataFrame], trip_ids: TripIds, as_of: AsOf, minutes: int) -> DataFrame:
    """Trip updates of messages received within the last ``minutes``, with their stop rows."""
    since = instant(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    feeds = live["feed_messages"].where(F.col("received_at") > since)
    updates = to_parent(_of_trips(live["trip_updates"], trip_ids), feeds, "feed_message_id",
                        "source_id", "received_at")
    facts = ["stop_id", "stop_sequence", "arrival_delay", "departure_delay"]
    stops = live["stop_time_updates"]
    on = parent_key(updates, stops, "trip_update_id")
    return (updates.select(*on, "trip_id", "route_id", "source_id", "received_at")
            .join(stops.select(*on, *facts, "schedule_relationship"), on, "left"))


def get_trip_realtime_data(live: dict[str, DataFrame], trip_ids: TripIds, as_of: AsOf,
                           source_id: int | None = None) -> DataFrame:
    """Stop rows of the asked trips from the last half hour, in trip and stop order."""
    rows = _recent(live, trip_ids, as_of, 30)
    if source_id is not None:
        rows = rows.where(F.col("source_id") == source_id)
    return (rows.orderBy("trip_id", F.asc_nulls_last("stop_sequence"))
            .select("trip_id", "route_id", "stop_id", "departure_delay", "arrival_delay",
                    "schedule_relationship", "received_at"))


def trip_update_batch(live: dict[str, DataFrame], trip_ids: TripIds, as_of: AsOf) -> DataFrame:
    """One row per trip for the last hour: the stops touched and the number of rows.

    Stops are counted before they are gathered, so what a trip collects is its distinct
    stops. A trip seen under several routes or sources reports the first of them.
    """
    group = ["trip_id", "route_id", "source_id"]
    per_stop = (_recent(live, trip_ids, as_of, 60).groupBy(*group, "stop_id")
                .agg(F.count(F.lit(1)).alias("n")))
    per_group = per_stop.groupBy(*group).agg(
        # Wrapped in a struct so that a trip without stop rows lists one missing stop.
        F.sort_array(F.collect_list(F.struct(F.col("stop_id").isNull().alias("missing"), "stop_id")))
        .alias("stops"),
        F.sum("n").alias("update_count"))
    first = F.struct(F.col("route_id").isNull(), "route_id", "source_id")
    return (per_group.groupBy("trip_id")
            .agg(F.min_by(F.struct(*group[1:], "stops", "update_count"), first).alias("g"))
            .select("trip_id", "g.route_id", "g.source_id",
                    F.transform("g.stops", lambda s: s["stop_id"]).alias("stop_ids"),
                    "g.update_count"))
