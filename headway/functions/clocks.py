"""Service clocks, dates and the seconds-since-midnight type."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from headway.schemas import SERVICE_ZONE, WEEKDAYS

DAY = 86400
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799

# Accepted text forms.
SERVICE_TIME = r"^[+-]?[0-9]+:[+-]?[0-9]+:[+-]?[0-9]+\z"
CLOCK_TIME = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]\z"
SERVICE_DATE = r"^[0-9]{8}\z"
NAIVE_STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?\z"
ZONED_STAMP = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?"
               r"(Z|[+-][0-9]{2}:[0-9]{2})\z")

AsOf = dt.datetime | str | Column


def instant(as_of: AsOf) -> Column:
    """The moment a query is asked for. Text and naive datetimes are read as UTC.

    A literal stays foldable, so comparisons with it reach the Parquet scan; a column
    (for example a scalar subquery) is passed through.
    """
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    since = as_of - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(since // dt.timedelta(microseconds=1)))


class ServiceClock(NamedTuple):
    seconds: Column
    date: Column
    yesterday: Column


def service_clock(as_of: AsOf, zone: str = SERVICE_ZONE) -> ServiceClock:
    """Wall-clock seconds, date and the date before, in the service zone."""
    local = F.convert_timezone(None, F.lit(zone), instant(as_of))
    seconds = F.hour(local) * 3600 + F.minute(local) * 60 + F.floor(F.second(local)).cast("int")
    date = local.cast("date")
    return ServiceClock(seconds, date, F.date_sub(date, 1))


def gtfs_time_to_seconds(text: Column) -> Column:
    """``H:M:S`` to seconds, hours past 24 allowed, anything else NULL."""
    # Cutting at the separators is several times cheaper than splitting into an array.
    hours = F.substring_index(text, ":", 1)
    minutes = F.substring_index(F.substring_index(text, ":", 2), ":", -1)
    whole = lambda part: part.try_cast("bigint")
    total = F.try_add(
        F.try_add(F.try_multiply(whole(hours), F.lit(3600)), F.try_multiply(whole(minutes), F.lit(60))),
        whole(F.substring_index(text, ":", -1)))
    return F.when(text.rlike(SERVICE_TIME), total.try_cast("int"))


def clock_to_seconds(text: Column) -> Column:
    """``HH:mm:ss`` within one day to seconds, anything else NULL."""
    return F.when(text.rlike(CLOCK_TIME), gtfs_time_to_seconds(text))


def gtfs_date(text: Column) -> Column:
    """``yyyyMMdd`` to a date, anything else NULL."""
    return F.when(text.rlike(SERVICE_DATE),
                  F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))


def posix_to_timestamp(seconds: Column) -> Column:
    """Seconds since 1970 to a timestamp; NULL outside the years 1 to 9999 (a stamp in
    milliseconds or less), so that one bad stamp cannot end a stream."""
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))


def portal_timestamp(text: Column, naive_zone: str = "UTC") -> Column:
    """A portal stamp with or without zone; ``naive_zone`` applies where none is given."""
    return (F.when(text.rlike(ZONED_STAMP), text.try_cast("timestamp"))
             .when(text.rlike(NAIVE_STAMP),
                   F.concat(text, F.lit(" " + naive_zone)).try_cast("timestamp")))


def effective_seconds(seconds: Column, day_offset: Column) -> Column:
    """Seconds on today's clock of a time counted from ``day_offset`` days ago."""
    return seconds - day_offset * DAY


def seconds_to_clock(seconds: Column) -> Column:
    """``HH:mm:ss``, wrapped at midnight."""
    s = F.pmod(seconds, F.lit(DAY))
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("int"),
                           F.floor(s % 3600 / 60).cast("int"), (s % 60).cast("int"))


def seconds_to_interval(seconds: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def runs_on(date: Column) -> Column:
    """Whether a calendar row's weekday flag is set for ``date``.

    With a literal date this folds to a test of one flag column.
    """
    return F.get(F.array(*[F.col(d) for d in WEEKDAYS]), F.weekday(date)) == 1


def relative_position(seconds: Column, now: Column) -> Column:
    gap = seconds - now
    return F.when(gap < 0, "past").when(gap <= 300, "imminent").otherwise("future")


def day_age(as_of: AsOf, then: Column) -> Column:
    """Whole 24-hour units between ``then`` and ``as_of``."""
    micros = F.unix_micros(instant(as_of)) - F.unix_micros(then)
    return F.floor(micros / F.lit(DAY * 1_000_000)).cast("int")


def iso_utc(ts: Column) -> Column:
    """ISO text of a UTC timestamp without trailing fraction zeros."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit("+00:00"))
