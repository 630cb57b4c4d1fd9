"""Which services run on which dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.clocks import AsOf, runs_on, service_clock
from headway.operators.versions import in_scope
from headway.schemas import SERVICE_ZONE, WEEKDAYS

SERVICE_KEY = ["source_id", "version_id", "service_id"]


def service_days(calendar: DataFrame, calendar_dates: DataFrame, first: Column,
                 last: Column) -> DataFrame:
    """(service_date, service) for every day from ``first`` to ``last``; removal wins.

    Each calendar row is unfolded over the few days its range shares with the asked one,
    exceptions are laid beside it, and one partial-then-final aggregation drops whatever
    any removal touches.
    """
    scheduled = (
        calendar.where((F.col("start_date") <= last) & (F.col("end_date") >= first)
                       & (F.col("start_date") <= F.col("end_date")))
        .select(*SERVICE_KEY, *WEEKDAYS,
                F.explode(F.sequence(F.greatest("start_date", first),
                                     F.least("end_date", last))).alias("service_date"))
        .where(runs_on(F.col("service_date")))
        .select(*SERVICE_KEY, "service_date", F.lit(False).alias("removed")))
    exceptions = (
        calendar_dates.where((F.col("date") >= first) & (F.col("date") <= last)
                             & F.col("exception_type").isin(1, 2))
        .select(*SERVICE_KEY, F.col("date").alias("service_date"),
                (F.col("exception_type") == 2).alias("removed")))
    return (scheduled.unionByName(exceptions)
            .groupBy(*SERVICE_KEY, "service_date").agg(F.bool_or("removed").alias("removed"))
            .where("not removed").drop("removed"))


def active_services(calendar: DataFrame, calendar_dates: DataFrame, date: Column) -> DataFrame:
    """Services running on ``date``: the calendar plus additions, less removals."""
    return service_days(calendar, calendar_dates, date, date).drop("service_date")


def service_activity(calendar: DataFrame, calendar_dates: DataFrame, date: Column) -> DataFrame:
    """Every known service with whether it runs on ``date``; here an addition wins."""
    no = F.lit(False)
    in_range = date.between(F.col("start_date"), F.col("end_date"))
    listed = calendar.select(*SERVICE_KEY, (in_range & runs_on(date)).alias("scheduled"),
                             no.alias("added"), no.alias("removed"))
    on_date = F.col("date") == date
    exceptions = calendar_dates.select(
        *SERVICE_KEY, no.alias("scheduled"), (on_date & (F.col("exception_type") == 1)).alias("added"),
        (on_date & (F.col("exception_type") == 2)).alias("removed"))
    seen = listed.unionByName(exceptions).groupBy(*SERVICE_KEY).agg(
        *[F.coalesce(F.bool_or(c), no).alias(c) for c in ("scheduled", "added", "removed")])
    return seen.select(*SERVICE_KEY, (F.expr("scheduled and not removed or added")).alias("is_active"))


def is_service_active(tables: dict[str, DataFrame], source_id: int, service_id: str, date: Column,
                      version_id: int | None = None) -> DataFrame:
    """One row telling whether one service runs on ``date``; unknown services do not."""
    mine = [in_scope(tables[n], tables["versions"], source_id, version_id)
            .where(F.col("service_id") == service_id) for n in ("calendar", "calendar_dates")]
    return service_activity(*mine, date).agg(
        F.coalesce(F.bool_or("is_active"), F.lit(False)).alias("is_active"))


def upcoming_services(tables: dict[str, DataFrame], as_of: AsOf, zone: str = SERVICE_ZONE,
                      version_id: int | None = None) -> DataFrame:
    """Services of each day from yesterday to a week ahead (the saved service view).

    A calendar row unfolds into a row per day, so the rows are spread over tasks while they are few.
    """
    today = service_clock(as_of, zone).date
    calendar, exceptions = [in_scope(tables[n], tables["versions"], None, version_id)
                            for n in ("calendar", "calendar_dates")]
    calendar = calendar.repartition(*SERVICE_KEY)
    return (service_days(calendar, exceptions, F.date_sub(today, 1), F.date_add(today, 7))
            .select("service_date", "source_id", "service_id"))
