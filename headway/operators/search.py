"""Finding stops and routes by place or by name.

A search text is one literal, so each name search is a single pass over the names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.texts import overlap_share, tokens, trigrams, unaccent

# Fixed value: the sphere the distance functions assume, in metres.
EARTH_RADIUS = 6378168.0
METRES_PER_DEGREE = EARTH_RADIUS * 3.141592653589793 / 180


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    lat1, lon1, lat2, lon2 = [F.radians(c) for c in (lat1, lon1, lat2, lon2)]
    half = (F.pow(F.sin((lat2 - lat1) / 2), 2)
            + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2))
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.least(F.lit(1.0), F.sqrt(half)))


def nearby_stops(stops: DataFrame, lat: float, lon: float, radius_m: float) -> DataFrame:
    """Stops within ``radius_m`` of a point, nearest first.

    The latitude band is a plain comparison, so the scan can skip row groups; the exact
    distance decides.
    """
    band = radius_m / METRES_PER_DEGREE * 1.000001
    y, x = F.col("stop_lat").cast("double"), F.col("stop_lon").cast("double")
    return (stops.where(F.col("stop_lat").between(lat - band, lat + band)
                        & F.col("stop_lon").isNotNull())
            .withColumn("distance_m", distance_m(F.lit(lat), F.lit(lon), y, x))
            .where(F.col("distance_m") <= radius_m)
            .orderBy("distance_m", "stop_id"))


def vehicles_near_stops(positions: DataFrame, stops: DataFrame, radius_m: float,
                        key: list[str]) -> DataFrame:
    """For each position (identified by ``key``): the nearest stop within ``radius_m`` and how
    many stops lie within it. Positions near no stop are left out.

    Positions and stops meet in grid cells a radius wide. Positions on the same spot are
    answered once, which also takes the weight out of a depot or terminus where very many
    vehicles report; the answer is then joined back to them.
    """
    reach = radius_m / METRES_PER_DEGREE * 1.000001
    y, x = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    located = positions.select(*key, "source_id", y.alias("lat"), x.alias("lon"))
    spots = located.select("source_id", "lat", "lon").distinct()

    # A degree of longitude is shortest at the high-latitude edge of a spot's band of cells.
    row = F.floor(F.col("lat") / reach)
    shrink = lambda r: F.greatest(F.cos(F.radians(F.least(
        F.lit(89.9), F.greatest(F.abs(r * reach), F.abs((r + 1) * reach))))), F.lit(1e-6))
    width = lambda r: F.lit(reach) / shrink(r)
    column = lambda lon, r: F.floor(lon / width(r))

    placed = (stops.select("source_id", "stop_id", F.col("stop_lat").cast("double").alias("stop_lat"),
                           F.col("stop_lon").cast("double").alias("stop_lon")).dropna()
              .withColumn("row", F.floor(F.col("stop_lat") / reach))
              .withColumn("col", column(F.col("stop_lon"), F.col("row"))))
    # A spot looks into three rows of cells; in each, cell widths differ, so the columns are
    # those its own reach covers there.
    looks = (spots.withColumn("row", F.explode(F.sequence(row - 1, row + 1)))
             .withColumn("slack", F.lit(reach) / shrink(row - 1) * 1.01)
             .withColumn("slack", F.greatest("slack", F.lit(reach) / shrink(row + 1) * 1.01))
             # Beyond the 180th meridian a spot looks from the other side as well.
             .withColumn("from", F.explode(F.array_compact(F.array(
                 "lon",
                 F.when((F.col("lon") + F.col("slack") > 180) & (F.col("slack") < 90), F.col("lon") - 360),
                 F.when((F.col("lon") - F.col("slack") < -180) & (F.col("slack") < 90), F.col("lon") + 360)))))
             .withColumn("col", F.explode(F.sequence(
                 column(F.col("from") - F.col("slack"), F.col("row")),
                 column(F.col("from") + F.col("slack"), F.col("row"))))))
    near = (looks.join(placed, ["source_id", "row", "col"])
            .withColumn("distance_m", distance_m(F.col("lat"), F.col("lon"),
                                                 F.col("stop_lat"), F.col("stop_lon")))
            .where(F.col("distance_m") <= radius_m)
            .groupBy("source_id", "lat", "lon")
            .agg(F.count(F.lit(1)).alias("stops_near"),
                 F.min(F.struct("distance_m", "stop_id")).alias("nearest")))
    return (located.join(near, ["source_id", "lat", "lon"])
            .select(*key, F.col("nearest.stop_id").alias("nearest_stop_id"),
                    F.col("nearest.distance_m").alias("distance_m"), "stops_near"))


def search_name_lower(names: DataFrame, column: str, text: str, prefix: bool = False) -> DataFrame:
    """Names equal to, or beginning with, ``text`` whatever the case."""
    name, wanted = F.lower(column), F.lower(F.lit(text))
    return names.where(F.startswith(name, wanted) if prefix else name == wanted)


def search_name_trigram(names: DataFrame, column: str, text: str,
                        threshold: float = 0.3) -> DataFrame:
    """Names sharing at least ``threshold`` of their three-letter pieces with ``text``.

    Taking a name apart costs far more than reading it, so names are spread over tasks first, and
    each is taken apart once: what is unfolded is the share itself, if it is high enough.
    """
    wanted = trigrams(F.lit(text))
    shares = F.transform(F.array(trigrams(F.col(column))), lambda pieces: overlap_share(pieces, wanted))
    high = F.filter(shares, lambda share: share >= threshold)
    return (names.repartition(column).select("*", F.explode_outer(high).alias("similarity"))
            .where(F.col("similarity").isNotNull()).orderBy(F.desc("similarity"), column))


def search_name_tokens(names: DataFrame, columns: list[str], text: str) -> DataFrame:
    """Names that hold every word of ``text`` (words taken as they are, no stemming)."""
    joined = F.concat_ws(" ", *[F.col(c) for c in columns])
    wanted = tokens(F.lit(text))
    held = F.size(F.array_intersect(tokens(joined), wanted))
    return names.where((held == F.size(wanted)) & (F.size(wanted) > 0))


def search_name_unaccented(names: DataFrame, column: str, text: str) -> DataFrame:
    """Names containing ``text``, blind to case and accents."""
    plain = lambda c: F.lower(unaccent(c))
    return names.where(F.contains(plain(F.col(column)), plain(F.lit(text))))
