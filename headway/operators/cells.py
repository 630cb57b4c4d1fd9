"""Places along a space-filling curve: circles and nearest places by ranges of a stored key.

The key of a place interleaves the bits of its longitude and latitude (Z-order), so neighbours
mostly have neighbouring keys. Places are stored sorted by it; a circle becomes a few ranges of
keys, which reach the scan and skip what lies elsewhere, and exact distances decide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.operators.search import EARTH_RADIUS, METRES_PER_DEGREE, distance_m

BITS = 20         # of each coordinate: cells of about 20 by 40 metres at the equator
MOST_CELLS = 32   # that a circle is covered with
FIRST_RING = 500.0  # metres
WIDER = 4         # times wider each further ring
SLACK = 1.000001

# Shifts and masks that set the bits of a number apart.
SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
          (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread(x: Column) -> Column:
    for shift, mask in SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def _spread_number(x: int) -> int:
    for shift, mask in SPREAD:
        x = (x | x << shift) & mask
    return x


def cell_key(lat: Column, lon: Column) -> Column:
    """Key of a place; NULL where a coordinate is missing or no place on earth."""
    top = F.lit((1 << BITS) - 1).cast("long")
    y = F.least(F.floor((lat + 90) / 180 * (1 << BITS)), top)
    x = F.least(F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * (1 << BITS)), top)
    return F.when(lat.between(-90, 90) & lon.between(-360, 360),
                  _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1)))


def write_places(stops: DataFrame, path: str) -> None:
    """Stops with ``cell``, spread and sorted by it; those without coordinates are left out."""
    at = cell_key(F.col("stop_lat").cast("double"), F.col("stop_lon").cast("double"))
    (stops.withColumn("cell", at).where(F.col("cell").isNotNull()).repartitionByRange("cell")
     .sortWithinPartitions("cell").write.mode("overwrite").parquet(path))


def load_places(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _columns(lat: float, lon: float, degrees: float) -> list[tuple[float, float]]:
    """Longitudes a circle can reach, as parts of 0 to 360 degrees east of the date line."""
    if abs(lat) + degrees >= 90:
        return [(0.0, 360.0)]
    half = math.degrees(math.asin(min(1.0, math.sin(math.radians(degrees)) / math.cos(math.radians(lat))))) * SLACK
    west, east = (lon + 180 - half) % 360, (lon + 180 + half) % 360
    if half >= 180:
        return [(0.0, 360.0)]
    return [(west, east)] if west <= east else [(west, 360.0), (0.0, east)]


def key_ranges(lat: float, lon: float, radius_m: float) -> list[tuple[int, int]]:
    """Ranges of keys, both ends in, that hold every place within ``radius_m`` of a point.

    The finest cells of which ``MOST_CELLS`` cover the circle's box; neighbours along the curve
    make one range.
    """
    degrees = min(180.0, radius_m / METRES_PER_DEGREE * SLACK)
    top = (1 << BITS) - 1
    low, high = (min(top, max(0, math.floor((y + 90) / 180 * (1 << BITS))))
                 for y in (lat - degrees, lat + degrees))
    spans = [tuple(min(top, math.floor(x / 360 * (1 << BITS))) for x in part)
             for part in _columns(lat, lon, degrees)]
    for drop in range(BITS + 1):
        rows = range(low >> drop, (high >> drop) + 1)
        columns = {x for a, b in spans for x in (range(a >> drop, (b >> drop) + 1)
                                                 if (b >> drop) - (a >> drop) < MOST_CELLS else range(MOST_CELLS + 1))}
        if len(rows) * len(columns) <= MOST_CELLS:
            break
    merged: list[list[int]] = []
    for key in sorted(_spread_number(x) | _spread_number(y) << 1 for x in columns for y in rows):
        first, last = key << 2 * drop, ((key + 1) << 2 * drop) - 1
        if merged and merged[-1][1] + 1 == first:
            merged[-1][1] = last
        else:
            merged.append([first, last])
    return [(a, b) for a, b in merged]


def _covered(places: DataFrame, lat: float, lon: float, radius_m: float) -> DataFrame:
    inside = F.lit(False)
    for first, last in key_ranges(lat, lon, radius_m):
        inside = inside | F.col("cell").between(first, last)
    return places.where(inside)


def places_in_circle(places: DataFrame, lat: float, lon: float, radius_m: float) -> DataFrame:
    """Stored places within ``radius_m`` of a point, nearest first."""
    y, x = F.col("stop_lat").cast("double"), F.col("stop_lon").cast("double")
    return (_covered(places, lat, lon, radius_m)
            .withColumn("distance_m", distance_m(F.lit(lat), F.lit(lon), y, x))
            .where(F.col("distance_m") <= radius_m).drop("cell").orderBy("distance_m", "stop_id"))


def nearest_places(places: DataFrame, lat: float, lon: float, k: int,
                   first_m: float = FIRST_RING) -> DataFrame:
    """The ``k`` stored places nearest to a point, equally near ones by id (all, if fewer).

    Circles grow until one holds ``k``; each reads its own ranges of keys, and only a count up to
    ``k`` goes to the driver. A circle half around the earth holds all there are.
    """
    radius, all_around = first_m, EARTH_RADIUS * math.pi * SLACK
    while True:
        found = places_in_circle(places, lat, lon, min(radius, all_around))
        if radius >= all_around or found.limit(k).count() == k:
            return found.limit(k)
        radius *= WIDER
