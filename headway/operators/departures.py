"""Scheduled calls at stops: the next departures, boards, timetables, live delays.

``tables`` maps table names to DataFrames of all sources and versions. Unless a version is
given, the active one is used throughout. Where ``trip_ends`` (the last stop of each trip, kept
at load) is among them it is read, otherwise last stops are computed from the stop times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from headway.functions.clocks import (
    DAY, AsOf, effective_seconds, instant, relative_position,
    seconds_to_clock, seconds_to_interval, service_clock)
from headway.operators.parents import to_parent
from headway.operators.services import active_services, service_days
from headway.operators.stops import (
    ROUTE_FACTS, last_sequences, platform_edges, platform_label, resolve_stop_platforms)
from headway.operators.versions import in_scope
from headway.schemas import SCOPE, SERVICE_ZONE

Tables = dict[str, DataFrame]
TRIP = [*SCOPE, "trip_id"]

BOARD = ["trip_id", "route_id", *ROUTE_FACTS, "trip_headsign", "stop_id", "stop_name",
         "scheduled_departure_time_seconds", "scheduled_departure_time", "stop_sequence",
         "pickup_type", "drop_off_type", "source_id", "version_id", "platform_id",
         "direction_id"]


def _mine(tables: Tables, source_id: int | None, version_id: int | None):
    return lambda name: in_scope(tables[name], tables["versions"], source_id, version_id)


def _running_trips(mine, clock) -> DataFrame:
    """Trips of today's (offset 0) and yesterday's (offset 1) services."""
    running = (service_days(mine("calendar"), mine("calendar_dates"), clock.yesterday, clock.date)
               .withColumn("day_offset", F.date_diff(clock.date, F.col("service_date")))
               .drop("service_date"))
    trips = mine("trips").select(*TRIP, "route_id", "service_id", "trip_headsign", "direction_id")
    return trips.join(running, [*SCOPE, "service_id"])


def _due(calls: DataFrame, running: DataFrame, clock) -> DataFrame:
    """Calls still to come on either service day, in seconds of today's clock.

    One pass serves both days: a call of yesterday's service is due when it lies at least a
    day past its midnight, which the comparison with the present implies.
    """
    coming = calls.where(F.col("departure_time_seconds") >= clock.seconds)
    seconds = effective_seconds(F.col("departure_time_seconds"), F.col("day_offset"))
    return (coming.join(running, TRIP)
            .withColumn("scheduled_departure_time_seconds", seconds)
            .where((F.col("scheduled_departure_time_seconds") >= clock.seconds)
                   & ((F.col("day_offset") == 0) | (F.col("departure_time_seconds") >= DAY))))


def _not_last(due: DataFrame, ends: DataFrame) -> DataFrame:
    """Without the calls at which their trip ends."""
    return (due.join(ends.select(*TRIP, "last_sequence"), TRIP)
            .where("stop_sequence < last_sequence").drop("last_sequence"))


TOLD = 200  # stops that a filter names one by one, at most
CALL = ["stop_id", "stop_sequence", "departure_time_seconds", "pickup_type", "drop_off_type"]


def _finish(due: DataFrame, routes: DataFrame, platform_numbers: DataFrame | None,
            asked) -> DataFrame:
    """Route facts, platform label and the clock form of the departure."""
    facts = routes.select(*SCOPE, "route_id", *ROUTE_FACTS)
    return (platform_label(due.join(facts, [*SCOPE, "route_id"]), platform_numbers)
            .withColumn("scheduled_departure_time",
                        seconds_to_clock(F.col("scheduled_departure_time_seconds")))
            .withColumn("stop_id", asked))


def _at_stops(calls: DataFrame, stops: DataFrame) -> DataFrame:
    """``calls`` with the ids of ``stops`` as a filter for the scan, where they are few enough to
    be told; else all calls. Either way the caller joins them to ``stops``."""
    ids = [r["stop_id"] for r in stops.select("stop_id").distinct().limit(TOLD + 1).collect()]
    return calls.where(F.col("stop_id").isin(ids)) if len(ids) <= TOLD else calls


def get_stop_departures(tables: Tables, stop_id: str, source_id: int, as_of: AsOf,
                        limit: int = 50, version_id: int | None = None,
                        zone: str = SERVICE_ZONE) -> DataFrame:
    """The next ``limit`` departures at a stop and its platforms.

    Today's calls have no upper bound, so runs past midnight are listed with more than a
    day's seconds and a wrapped clock. A trip's last stop is no departure.

    The platforms of one stop are looked up at once, so that the scan of the timetable is told
    their ids and skips the files and row groups of other stops.
    """
    mine, clock = _mine(tables, source_id, version_id), service_clock(as_of, zone)
    platforms = resolve_stop_platforms(mine("stops"), stop_id).select(*SCOPE, "stop_id", "stop_name")
    at_platforms = _at_stops(mine("stop_times"), platforms)
    calls = at_platforms.select(*TRIP, *CALL).join(platforms, [*SCOPE, "stop_id"])
    due = _due(calls, _running_trips(mine, clock), clock)
    if "trip_ends" in tables:
        ends = mine("trip_ends")
    else:
        # Last stops are only needed of the trips that call here.
        here = (at_platforms.where(F.col("departure_time_seconds") >= clock.seconds)
                .join(platforms, [*SCOPE, "stop_id"], "left_semi").select(*TRIP))
        ends = last_sequences(mine("stop_times").join(here, TRIP, "left_semi"))
    board = _finish(_not_last(due, ends), mine("routes"), tables.get("platform_numbers"),
                    F.lit(stop_id))
    return (board.orderBy("scheduled_departure_time_seconds", "trip_id", "stop_sequence")
            .limit(limit).select(*BOARD))


def scheduled_departures(tables: Tables, as_of: AsOf, version_id: int | None = None,
                         zone: str = SERVICE_ZONE) -> DataFrame:
    """Every departure still to come, of all stops of all sources."""
    mine, clock = _mine(tables, None, version_id), service_clock(as_of, zone)
    # Route existence is settled per trip, before trips meet their many calls.
    running = _running_trips(mine, clock).join(mine("routes"), [*SCOPE, "route_id"], "left_semi")
    ends = mine("trip_ends") if "trip_ends" in tables else last_sequences(mine("stop_times"))
    return _not_last(_due(mine("stop_times").select(*TRIP, *CALL), running, clock), ends)


def departure_board(tables: Tables, as_of: AsOf, k: int = 50, version_id: int | None = None,
                    zone: str = SERVICE_ZONE) -> DataFrame:
    """``get_stop_departures`` for every stop at once: the next ``k`` of each.

    The ranking keeps at most ``k`` rows per stop and task before it shuffles, so a busy
    stop never gathers its whole timetable; descriptions are joined to what is left.
    """
    mine = _mine(tables, None, version_id)
    at_stops = (scheduled_departures(tables, as_of, version_id, zone)
                .join(platform_edges(mine("stops")), [*SCOPE, "stop_id"]))
    order = Window.partitionBy(*SCOPE, "asked_stop_id").orderBy(
        "scheduled_departure_time_seconds", "trip_id", "stop_sequence")
    top = (at_stops.withColumn("position", F.row_number().over(order))
           .where(F.col("position") <= k))
    return (_finish(top, mine("routes"), tables.get("platform_numbers"), F.col("asked_stop_id"))
            .select(*BOARD, "position"))


def _clock_argument(text: str) -> int:
    """Seconds of ``HH:MM`` or ``HH:MM:SS``; 24:00:00 is the end of the day."""
    parts = [int(x) for x in text.split(":")]
    hours, minutes, seconds = parts if len(parts) == 3 else (*parts, 0)
    total = hours * 3600 + minutes * 60 + seconds
    if not (0 <= hours <= 24 and 0 <= minutes < 60 and 0 <= seconds < 60 and total <= DAY):
        raise ValueError(f"not a time of day: {text}")
    return total


def get_scheduled_stop_times(tables: Tables, source_id: int, stop_id: str, as_of: AsOf,
                             from_time: str | None = None, to_time: str | None = None,
                             route_types: Sequence[int] | None = None, limit: int = 100,
                             version_id: int | None = None,
                             zone: str = SERVICE_ZONE) -> DataFrame:
    """Arrivals of today's services at a stop within a time window, earliest first.

    The window ends 48 hours after midnight unless ``to_time`` says otherwise, so runs past
    midnight are in it. One row is kept per arrival time and trip.
    """
    mine, clock = _mine(tables, source_id, version_id), service_clock(as_of, zone)
    start = 0 if from_time is None else _clock_argument(from_time)
    end = 2 * DAY if to_time is None else _clock_argument(to_time)
    # The same window a day later lies inside this one, as both end at the same moment.
    arrivals = (mine("stop_times")
                .where((F.col("stop_id") == stop_id)
                       & F.col("arrival_time_seconds").between(start, end))
                .groupBy(*TRIP, "arrival_time_seconds")
                .agg(F.min(F.struct("stop_sequence", "departure_time_seconds", "stop_headsign"))
                     .alias("call")))
    running = mine("trips").join(
        active_services(mine("calendar"), mine("calendar_dates"), clock.date),
        [*SCOPE, "service_id"], "left_semi")
    routes = mine("routes")
    if route_types:
        routes = routes.where(F.col("route_type").isin(list(route_types)))
    agencies = mine("agency").select(*SCOPE, "agency_id", "agency_name", "agency_timezone")
    return (arrivals
            .join(running.select(*TRIP, "route_id", "service_id", "trip_headsign", "direction_id"),
                  TRIP)
            .join(routes.select(*SCOPE, "route_id", "agency_id", *ROUTE_FACTS), [*SCOPE, "route_id"])
            .join(agencies, [*SCOPE, "agency_id"])
            .orderBy("arrival_time_seconds", "trip_id").limit(limit)
            .select(seconds_to_interval(F.col("arrival_time_seconds"))
                    .alias("arrival_time_with_offset"),
                    seconds_to_interval(F.col("call.departure_time_seconds"))
                    .alias("departure_time_with_offset"),
                    "trip_id", "trip_headsign", F.lit(None).cast("string").alias("trip_short_name"),
                    "call.stop_headsign", "route_id", *ROUTE_FACTS, "agency_id", "agency_name",
                    "agency_timezone", "service_id", "direction_id", "call.stop_sequence",
                    relative_position(F.col("arrival_time_seconds"), clock.seconds)
                    .alias("relative_position")))


def latest_stop_updates(stop_time_updates: DataFrame, trip_updates: DataFrame,
                        feed_messages: DataFrame, as_of: AsOf, window: str = "1 hour",
                        zone: str = SERVICE_ZONE) -> DataFrame:
    """The newest update of each call, of those received within ``window`` up to ``as_of``.

    A call is told by source, trip, service day (offset 0 is today's, 1 yesterday's) and stop
    sequence; updates without a sequence (-1) are told by their stop. An update that names no
    start date holds for both days, one of another day for none.

    The window is a filter on the messages, so batches outside it are pruned. A keyed maximum
    combines before the shuffle: a trip repeated in every message costs one row per task.
    """
    now, clock = instant(as_of), service_clock(as_of, zone)
    recent = feed_messages.where((F.col("received_at") > now - F.expr(f"interval {window}"))
                                 & (F.col("received_at") <= now))
    facts = F.struct("arrival_delay", "departure_delay", "schedule_relationship", "received_at")
    newest = F.struct("received_at", "trip_update_id", "stop_sequence", "stop_id")
    of_trips = to_parent(stop_time_updates, trip_updates, "trip_update_id", "feed_message_id",
                         "trip_id", "start_date")
    days = F.when(F.col("start_date").isNull(), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.date_diff(clock.date, F.col("start_date"))))
    named = F.col("stop_sequence") >= 0
    return (to_parent(of_trips, recent, "feed_message_id", "source_id", "received_at")
            .withColumn("day_offset", F.explode(days)).where("day_offset in (0, 1)")
            .groupBy("source_id", "trip_id", "day_offset",
                     F.when(named, F.col("stop_sequence")).alias("called_sequence"),
                     F.when(~named, F.col("stop_id")).alias("called_stop"))
            .agg(F.max_by(facts, newest).alias("u"))
            .select("source_id", "trip_id", "day_offset", "called_sequence", "called_stop",
                    "u.arrival_delay", "u.departure_delay",
                    F.col("u.schedule_relationship").alias("update_relationship"),
                    F.col("u.received_at").alias("updated_at")))


UPDATE = ["arrival_delay", "departure_delay", "update_relationship", "updated_at"]


def departures_with_delay(departures: DataFrame, updates: DataFrame) -> DataFrame:
    """Scheduled departures beside their newest update; without one they keep the schedule.

    An update of the call's own sequence comes before one that only names its stop.
    """
    run = ["source_id", "trip_id", "day_offset"]
    facts = F.struct(*UPDATE)
    by_call = updates.where("called_sequence is not null").select(
        *run, F.col("called_sequence").alias("stop_sequence"), facts.alias("_by_call"))
    by_stop = updates.where("called_stop is not null").select(
        *run, F.col("called_stop").alias("stop_id"), facts.alias("_by_stop"))
    told = (departures.join(by_call, [*run, "stop_sequence"], "left")
            .join(by_stop, [*run, "stop_id"], "left")
            .withColumn("_update", F.coalesce("_by_call", "_by_stop"))
            .select(*departures.columns, "_update.*"))
    expected = (F.col("scheduled_departure_time_seconds")
                + F.coalesce("departure_delay", "arrival_delay", F.lit(0)))
    return told.withColumn("expected_departure_time_seconds", expected)
