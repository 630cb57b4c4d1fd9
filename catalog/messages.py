"""Nested realtime messages derived from the events: twenty entities to a message, with the
odd ones a feed sends (failed fetches, unknown endpoints, missing parts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from catalog.derived import Tables
from headway import schemas as S
from headway.functions.codes import code_label
from headway.sources.feed_json import CODE_MEMBERS, camel


def _trip(e: Column, user: Column) -> Column:
    return F.struct(
        F.format_string("T%d", e * 13 % 1000).alias("trip_id"),
        F.format_string("R%d", user % 25).alias("route_id"),
        (e % 2).alias("direction_id"),
        F.format_string("%d:05:09", e % 28).alias("start_time"),
        F.when(e % 37 == 0, "soon").otherwise("20240115").alias("start_date"),
        F.when(e % 4 != 0, e % 4).alias("schedule_relationship"))


def _vehicle(e: Column, user: Column) -> Column:
    lat = F.lit(-38.0) + (e * 37 % 100).cast("double") / 100
    lon = F.lit(144.5) + (e * 53 % 100).cast("double") / 100
    return F.struct(
        F.when(e % 7 != 0, _trip(e, user)).alias("trip"),
        F.when(user % 10 != 0, F.struct(F.format_string("V%d", user).alias("id"),
                                        F.lit(None).cast("string").alias("label"),
                                        F.lit("ABC").alias("license_plate"))).alias("vehicle"),
        F.when(e % 23 != 0, F.struct(lat.alias("latitude"), lon.alias("longitude"),
                                     (e % 360).alias("bearing"))).alias("position"),
        (e % 3).alias("current_status"),
        F.when(F.col("event_type") != "view", F.format_string("S%d", user % 10)).alias("stop_id"),
        F.when(e % 31 != 0, F.unix_seconds("ts")).alias("timestamp"))


def _trip_update(e: Column, user: Column) -> Column:
    def stop(n: Column) -> Column:
        event = lambda delay, time: F.struct(delay.alias("delay"), time.alias("time"),
                                             F.lit(30).alias("uncertainty"))
        return F.struct(
            F.when(e % 8 != 0, n).alias("stop_sequence"),
            F.when(e % 11 != 0, F.format_string("S%d", (e + n) % 10)).alias("stop_id"),
            F.when(e % 6 != 0, event(e * 31 % 900 - 120 + n, e * 60 + 1704067200)).alias("arrival"),
            F.when(e % 9 != 0, event(e * 31 % 900 - 90, e * 60 + 1704067260)).alias("departure"),
            F.lit(0).alias("schedule_relationship"))
    stops = F.transform(F.filter(F.sequence(F.lit(1), F.lit(2)), lambda n: n <= e % 3), stop)
    trip = F.when(e % 19 != 0, _trip(e, user))
    return F.struct(trip.alias("trip"),
                    F.struct(F.format_string("V%d", user).alias("id"),
                             F.lit("Tram").alias("label"),
                             F.lit(None).cast("string").alias("license_plate")).alias("vehicle"),
                    F.when(e % 17 != 0, F.unix_seconds("ts")).alias("timestamp"),
                    (e * 31 % 900 - 120).alias("delay"), stops.alias("stop_time_update"))


def _alert(e: Column, user: Column) -> Column:
    period = lambda n: F.struct(
        (e * 7919 % 864000 + 1704067200).alias("start"),
        F.when((e + n) % 5 != 0, (e * 7919 + n * 400000) % 2592000 + 1704067200).alias("end"))
    selector = lambda n: F.struct(
        F.format_string("A%d", e % 5).alias("agency_id"),
        F.when(n != 3, F.format_string("R%d", e % 25)).alias("route_id"),
        (e % 2).alias("direction_id"),
        F.when(n == 2, _trip(e, user)).alias("trip"),
        F.when(n != 1, F.format_string("S%d", e % 10)).alias("stop_id"))
    text = lambda words, language: F.struct(F.array(F.struct(
        words.alias("text"), language.alias("language"))).alias("translation"))
    return F.struct(
        F.transform(F.filter(F.sequence(F.lit(1), F.lit(2)), lambda n: n <= e % 3), period)
        .alias("active_period"),
        F.transform(F.sequence(F.lit(1), F.lit(3)), selector).alias("informed_entity"),
        (e % 12 + 1).alias("cause"), (e % 11 + 1).alias("effect"),
        F.when(e % 13 != 0, e % 4 + 1).alias("severity_level"),
        F.when(e % 2 == 0, text(F.format_string("https://news.example/%d", e),
                                F.lit(None).cast("string"))).alias("url"),
        text(F.format_string("Works on route %d", e % 25), F.lit("en")).alias("header_text"),
        F.lit(None).cast(S.TEXT).alias("description_text"))


# Events of one task: their messages are many times as long, so small pieces are not joined.
EVENTS_PER_TASK = 25_000


def feed_messages(t: Tables) -> DataFrame:
    """One row per fetch; the twenty events of a message are its entities."""
    e, user, kind = F.col("event_id"), F.col("user_id"), F.col("kind")
    entity = F.struct(
        F.format_string("E%d", e).alias("id"), (e % 50 == 0).alias("is_deleted"),
        F.when((kind == 1) & (e % 29 != 0), _trip_update(e, user)).alias("trip_update"),
        F.when((kind == 0) & (e % 29 != 0), _vehicle(e, user)).alias("vehicle"),
        F.when((kind == 2) & (e % 29 != 0), _alert(e, user)).alias("alert")).cast(S.ENTITY)
    m = F.col("feed_message_id")
    feed = F.concat(F.when(F.col("half") == 0, "tram_").otherwise("metrotrain_"),
                    F.element_at(F.array(*[F.lit(x) for x in S.FEED_TYPES]), kind + 1))
    header = F.struct(
        F.lit("2.0").alias("gtfs_realtime_version"),
        F.when(m % 60 == 0, "DIFFERENTIAL").otherwise("FULL_DATASET").alias("incrementality"),
        F.when(m % 100 != 0, F.unix_seconds("first_ts")).alias("timestamp"),
        F.lit(None).cast("string").alias("feed_version"))
    failed = m % 700 == 40
    # Events are brought together while they are still narrow, then built into entities.
    tasks = max(1, -(-t["fx_ev"].count() // EVENTS_PER_TASK))
    return (t["fx_ev"].repartition(tasks, "feed_message_id").withColumn("entity", entity)
            .groupBy("feed_message_id", "kind", "half")
            .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("received_at"),
                 F.collect_list("entity").alias("entity"))
            .select(F.when(m % 900 == 20, "elsewhere").otherwise(feed).alias("endpoint"),
                    "received_at", F.when(failed, "timeout").alias("error"),
                    F.when(~failed, F.struct(header.alias("header"), F.col("entity")))
                    .alias("message")))


def _usual(value: Column, kind: T.DataType, name: str = "", around: str = "") -> Column:
    """``value`` with codes by name, 64-bit numbers as text and members in camel case."""
    if isinstance(kind, T.StructType):
        members = [_usual(value[f.name], f.dataType, f.name, name).alias(camel(f.name)) for f in kind]
        return F.when(value.isNotNull(), F.struct(*members))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: _usual(e, kind.elementType, name, around))
    if (around, name) in CODE_MEMBERS:
        return code_label(CODE_MEMBERS[around, name], value)
    return value.cast("string") if isinstance(kind, T.LongType) else value


def usual_lines(t: Tables) -> DataFrame:
    """The messages as lines of JSON in the form feeds usually have."""
    message = _usual(F.col("message"), S.FEED_MESSAGE["message"].dataType)
    zone = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    line = F.struct("endpoint", "received_at", "error", message.alias("message"))
    return feed_messages(t).select(F.to_json(line, zone).alias("value"))


def damaged_lines(t: Tables) -> DataFrame:
    """The messages as JSON lines, one in thirteen of each kind of damage; the number of a message is
    that of its entities. One in thirteen comes twice, the second with another header."""
    first = F.array_min(F.transform("message.entity", lambda e: F.substring(e["id"], 2, 18).cast("long")))
    kind = F.coalesce(F.floor(first / 20) % 13, F.lit(0))
    entity, header = F.col("message.entity"), F.col("message.header")
    renamed = F.transform(entity, lambda e: e.withField("id", F.lit(None).cast("string")))
    turned = F.transform(entity, lambda e: F.when(
        e["vehicle"]["position"].isNotNull(),
        e.withField("vehicle.position.bearing", F.lit(1234.0).cast("float"))).otherwise(e))
    placeless = F.transform(entity, lambda e: F.when(
        e["vehicle"]["position"].isNotNull(),
        e.withField("vehicle.position.latitude", F.lit(None).cast("float"))).otherwise(e))
    lengthy = F.transform(entity, lambda e: F.when(
        e["vehicle"].isNotNull(), e.withField("vehicle.stop_id", F.repeat(F.lit("S"), 51)))
        .when(e["trip_update"].isNotNull(), e.withField("trip_update.vehicle.label", F.repeat(F.lit("V"), 101)))
        .otherwise(e.withField("alert.url", F.struct(F.array(F.struct(
            F.lit("x").alias("text"), F.repeat(F.lit("e"), 11).alias("language"))).alias("translation")))))
    stops = lambda e: e["trip_update"]["stop_time_update"]
    again = F.transform(entity, lambda e: F.when(
        e["trip_update"].isNotNull(),
        e.withField("trip_update.stop_time_update", F.concat(stops(e), F.slice(stops(e), 1, 1)))).otherwise(e))
    speechless = F.transform(entity, lambda e: F.when(e["alert"].isNotNull(), e.withField(
        "alert.header_text", F.struct(F.array(F.struct(
            F.lit(None).cast("string").alias("text"), F.lit("en").alias("language"))).alias("translation"))))
        .otherwise(e))
    other = F.when(F.col("copy") == 0, header).otherwise(
        header.withField("feed_version", F.lit("again")))
    damaged = F.when(F.col("message").isNotNull(), F.struct(
        F.when(kind == 1, F.lit(None)).when(kind == 2, header.withField("timestamp", F.lit(10 ** 18)))
        .when(kind == 11, other).otherwise(header).alias("header"),
        F.when(kind == 3, F.concat(entity, F.slice(entity, 1, 1))).when(kind == 4, renamed)
        .when(kind == 5, turned).when(kind == 7, placeless).when(kind == 8, lengthy)
        .when(kind == 9, again).when(kind == 10, speechless).otherwise(entity).alias("entity")))
    zone = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    line = F.to_json(F.struct("endpoint", "received_at", "error", damaged.alias("message")), zone)
    copies = F.sequence(F.lit(0), F.when(kind == 11, 1).otherwise(0))
    return (feed_messages(t).select("*", F.explode(copies).alias("copy"))
            .select(F.concat(F.when(kind == 6, "#").otherwise(""), line).alias("value")))
