"""Typed rows of the eleven schedule tables, from text cells.

Shared rules: a missing cell is empty; a malformed number falls back to its default; a
calendar row whose date cannot be read is dropped. Empty optional text and zero optional
numbers become NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway import schemas as S
from headway.functions.clocks import gtfs_date, gtfs_time_to_seconds
from headway.functions.texts import blank_to_null, cell, real_number, whole_number, zero_to_null


def _text(name: str) -> Column:
    return F.col(name)


def _optional(name: str) -> Column:
    return blank_to_null(F.col(name)).alias(name)


def _int(name: str) -> Column:
    return whole_number(F.col(name)).alias(name)


def _optional_int(name: str) -> Column:
    return zero_to_null(whole_number(F.col(name))).alias(name)


def _real(name: str) -> Column:
    return real_number(F.col(name)).alias(name)


def _optional_real(name: str) -> Column:
    return zero_to_null(real_number(F.col(name))).alias(name)


def _date(name: str) -> Column:
    return gtfs_date(F.col(name)).alias(name)


def _typed(raw: DataFrame, version_id: int | Column, *columns: Column) -> DataFrame:
    """Typed columns over stripped cells. Cells are stripped in a projection of their own, so
    rules that look at a cell several times strip it once."""
    version = version_id if isinstance(version_id, Column) else F.lit(version_id).cast("int")
    cells = raw.select("source_id", *[cell(F.col(c)).alias(c) for c in raw.columns
                                      if c != "source_id"])
    return cells.select(*columns, "source_id", version.alias("version_id"))


def agency(raw: DataFrame, version_id) -> DataFrame:
    return _typed(raw, version_id, _text("agency_id"), _text("agency_name"),
                  _optional("agency_url"), _text("agency_timezone"), _optional("agency_lang"),
                  _optional("agency_fare_url"))


def stops(raw: DataFrame, version_id) -> DataFrame:
    return _typed(raw, version_id, _text("stop_id"), _text("stop_name"),
                  _optional_real("stop_lat").cast(S.COORD).alias("stop_lat"),
                  _optional_real("stop_lon").cast(S.COORD).alias("stop_lon"),
                  _int("location_type"), _optional("parent_station"),
                  _int("wheelchair_boarding"), _optional("level_id"))


def routes(raw: DataFrame, version_id) -> DataFrame:
    return _typed(raw, version_id, _text("route_id"), _optional("agency_id"),
                  _optional("route_short_name"), _optional("route_long_name"),
                  _int("route_type"), _optional("route_color"), _optional("route_text_color"))


def trips(raw: DataFrame, version_id) -> DataFrame:
    return _typed(raw, version_id, _text("trip_id"), _text("route_id"), _text("service_id"),
                  _optional("shape_id"), _optional("trip_headsign"), _int("direction_id"),
                  _optional("block_id"), _int("wheelchair_accessible"))


def stop_times(raw: DataFrame, version_id) -> DataFrame:
    seconds = lambda name: gtfs_time_to_seconds(F.col(name)).alias(f"{name}_seconds")
    return _typed(raw, version_id, _text("trip_id"), _text("stop_id"), _int("stop_sequence"),
                  seconds("arrival_time"), seconds("departure_time"), _optional("stop_headsign"),
                  _int("pickup_type"), _int("drop_off_type"),
                  _optional_real("shape_dist_traveled").cast(S.DIST).alias("shape_dist_traveled"))


def calendar(raw: DataFrame, version_id) -> DataFrame:
    rows = _typed(raw, version_id, _text("service_id"), *[_int(d) for d in S.WEEKDAYS],
                  _date("start_date"), _date("end_date"))
    return rows.where("start_date is not null and end_date is not null")


def calendar_dates(raw: DataFrame, version_id) -> DataFrame:
    rows = _typed(raw, version_id, _text("service_id"), _date("date"), _int("exception_type"))
    return rows.where("date is not null")


def shapes(raw: DataFrame, version_id) -> DataFrame:
    return _typed(raw, version_id, _text("shape_id"),
                  _real("shape_pt_lat").cast(S.COORD).alias("shape_pt_lat"),
                  _real("shape_pt_lon").cast(S.COORD).alias("shape_pt_lon"),
                  _int("shape_pt_sequence"),
                  _optional_real("shape_dist_traveled").cast(S.DIST).alias("shape_dist_traveled"))


def levels(raw: DataFrame, version_id, keep_zero_level: bool = False) -> DataFrame:
    """``keep_zero_level`` keeps ground level as 0; by default it is lost, as for any zero."""
    index = _real("level_index") if keep_zero_level else _optional_real("level_index")
    return _typed(raw, version_id, _text("level_id"), index.alias("level_index"),
                  _optional("level_name"))


def pathways(raw: DataFrame, version_id) -> DataFrame:
    return _typed(raw, version_id, _text("pathway_id"), _text("from_stop_id"),
                  _text("to_stop_id"), _int("pathway_mode"), _int("is_bidirectional"),
                  _optional_int("traversal_time"))


def transfers(raw: DataFrame, version_id) -> DataFrame:
    return _typed(raw, version_id, _text("from_stop_id"), _text("to_stop_id"),
                  _optional("from_route_id"), _optional("to_route_id"), _text("from_trip_id"),
                  _text("to_trip_id"), _int("transfer_type"), _optional_int("min_transfer_time"))


TYPED = {"agency": agency, "levels": levels, "stops": stops, "routes": routes,
         "calendar": calendar, "calendar_dates": calendar_dates, "shapes": shapes,
         "trips": trips, "stop_times": stop_times, "pathways": pathways, "transfers": transfers}
