"""Stops, their platforms, and the routes that serve them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from headway.operators.versions import in_scope
from headway.schemas import SCOPE

ROUTE_FACTS = ["route_short_name", "route_long_name", "route_type", "route_color",
               "route_text_color"]

# Fixed value: the source whose platforms carry numbers.
NUMBERED_SOURCE = 2

# Stop times that one task sorts and tells apart, so that its memory does not grow with the tables.
CALLS_PER_TASK = 200_000


def resolve_stop_platforms(stops: DataFrame, stop_id: str) -> DataFrame:
    """A stop itself and the stops whose parent it is."""
    return stops.where((F.col("stop_id") == stop_id) | (F.col("parent_station") == stop_id))


def platform_edges(stops: DataFrame) -> DataFrame:
    """(asked stop, platform) pairs of all stops at once; no shuffle."""
    asked = F.array_distinct(F.array_compact(F.array("stop_id", "parent_station")))
    return stops.select(*SCOPE, F.explode(asked).alias("asked_stop_id"), "stop_id", "stop_name")


def platform_label(departures: DataFrame, platform_numbers: DataFrame | None) -> DataFrame:
    """Adds ``platform_id``: the platform number where one is known, else the stop id."""
    if platform_numbers is None:
        return departures.withColumn("platform_id", F.col("stop_id"))
    number = F.when(F.col("source_id") == NUMBERED_SOURCE, F.col("platform_number"))
    return (departures
            .join(platform_numbers.select(F.col("platform_id").alias("stop_id"), "platform_number"),
                  "stop_id", "left")
            .withColumn("platform_id", F.coalesce(number, F.col("stop_id")))
            .drop("platform_number"))


def last_sequences(stop_times: DataFrame) -> DataFrame:
    """Highest stop sequence of each trip.

    A plain maximum combines before the shuffle and leaves one row per trip; the join with
    it can split a hot trip, which a window over the trip could not.
    """
    return stop_times.groupBy(*SCOPE, "trip_id").agg(F.max("stop_sequence").alias("last_sequence"))


def before_last_stop(stop_times: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """Stop times after which the trip still calls somewhere."""
    sequences = last_sequences(stop_times) if sequences is None else sequences
    return (stop_times.join(sequences, [*SCOPE, "trip_id"])
            .where("stop_sequence < last_sequence").drop("last_sequence"))


def _route_details(counts: DataFrame, routes: DataFrame, agency: DataFrame) -> DataFrame:
    return (counts
            .join(routes.select(*SCOPE, "route_id", "agency_id", *ROUTE_FACTS), [*SCOPE, "route_id"])
            .join(agency.select(*SCOPE, "agency_id", "agency_name"), [*SCOPE, "agency_id"]))


def get_stop_routes(tables: dict[str, DataFrame], source_id: int, stop_id: str,
                    version_id: int | None = None) -> DataFrame:
    """Routes serving one stop, with how many trips of each call there."""
    mine = lambda n: in_scope(tables[n], tables["versions"], source_id, version_id)
    calling = mine("stop_times").where(F.col("stop_id") == stop_id).select(*SCOPE, "trip_id").distinct()
    counts = (calling.join(mine("trips").select(*SCOPE, "trip_id", "route_id"), [*SCOPE, "trip_id"])
              .groupBy(*SCOPE, "route_id").agg(F.count(F.lit(1)).alias("trip_count")))
    return (_route_details(counts, mine("routes"), mine("agency"))
            .select("route_id", *ROUTE_FACTS, "agency_id", "agency_name", "trip_count")
            .orderBy("route_type", F.asc_nulls_last("route_short_name"),
                     F.asc_nulls_last("route_long_name"), "route_id"))


def stop_routes(tables: dict[str, DataFrame], version_id: int | None = None) -> DataFrame:
    """Routes serving each stop, with trip and service counts (the saved stop view).

    Stop times are counted first, and calls and trips dealt over as many tasks as that asks for:
    adaptive execution would join small pieces into tasks whose sorts and sets grow with the
    tables. Repeated calls of a trip are dropped before the join, by the same partitioning. A trip
    has one service, so trips are counted per service first; what is left to gather per stop and
    route is one row per service, however busy the stop.
    """
    mine = lambda n: in_scope(tables[n], tables["versions"], None, version_id)
    calls = mine("stop_times").select(*SCOPE, "stop_id", "trip_id")
    tasks = max(1, -(-calls.count() // CALLS_PER_TASK))
    runs = mine("trips").select(*SCOPE, "trip_id", "route_id", "service_id")
    calls, runs = [rows.repartition(tasks, *SCOPE, "trip_id").distinct() for rows in (calls, runs)]
    calling = calls.join(runs, [*SCOPE, "trip_id"])
    per_service = (calling.groupBy(*SCOPE, "stop_id", "route_id", "service_id")
                   .agg(F.count(F.lit(1)).alias("trips")))
    counts = per_service.groupBy(*SCOPE, "stop_id", "route_id").agg(
        F.sum("trips").alias("trip_count"), F.count(F.lit(1)).alias("service_count"),
        F.array_sort(F.collect_list("service_id")).alias("service_ids"))
    return (_route_details(counts, mine("routes"), mine("agency"))
            .select("source_id", "stop_id", "route_id", *ROUTE_FACTS, "agency_id", "agency_name",
                    "trip_count", "service_count", "service_ids"))
