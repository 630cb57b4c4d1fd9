"""Realtime messages and the endpoints they come from."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from headway.functions.clocks import posix_to_timestamp
from headway.operators.versions import active_version_id
from headway.schemas import ANGLE, COORD, FEED_MESSAGE, FEED_TYPES, MAX_LENGTH
from headway.sources.feed_json import accepted, misread, settled
from headway.sources.lookups import inline_rows

# Fixed values: (endpoint name, feed type, source name).
ENDPOINTS = [
    ("metrobus_trip_updates", "trip_updates", "Metropolitan Bus"),
    ("metrotrain_service_alerts", "service_alerts", "Metropolitan Train"),
    ("metrotrain_trip_updates", "trip_updates", "Metropolitan Train"),
    ("metrotrain_vehicle_positions", "vehicle_positions", "Metropolitan Train"),
    ("tram_service_alerts", "service_alerts", "Metropolitan Tram"),
    ("tram_trip_updates", "trip_updates", "Metropolitan Tram"),
    ("tram_vehicle_positions", "vehicle_positions", "Metropolitan Tram"),
]

MESSAGE_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}


MESSAGE = FEED_MESSAGE["message"].dataType


def _usable(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("error").isNull() & F.col("message").isNotNull())


def _of(rows: DataFrame, endpoints: Collection[str] | None) -> DataFrame:
    return rows if endpoints is None else rows.where(F.col("endpoint").isin(*endpoints))


def _lines(reader: DataFrameReader | DataStreamReader, path: str,
           endpoints: Collection[str] | None = None, **options: str) -> DataFrame:
    """Lines of JSON as they were written, in any form of ``feed_json``, with ``_raw``: the text
    of a line or message that is not readable as one. The reader itself passes over lines of other
    ``endpoints``, so nothing is built of them or looked for in them."""
    fields = [StructField(f.name, accepted(f.dataType) if f.name == "message" else f.dataType)
              for f in FEED_MESSAGE]
    rows = (reader.options(**MESSAGE_OPTIONS, columnNameOfCorruptRecord="_raw", **options)
            .schema(StructType([*fields, StructField("_raw", StringType())])).json(path))
    unread = F.when(misread(F.col("message"), MESSAGE), F.to_json("message"))
    return _of(rows, endpoints).withColumn("_raw", F.coalesce("_raw", unread))


def _readable(reader: DataFrameReader | DataStreamReader, path: str, fmt: str,
              endpoints: Collection[str] | None = None, **options: str) -> DataFrame:
    if fmt != "json":
        rows = reader.format(fmt).options(**options).schema(FEED_MESSAGE).load(path)
        return _usable(_of(rows, endpoints))
    return _usable(_lines(reader, path, endpoints, **options)).where("_raw is null").select(
        "endpoint", "received_at", "error", settled(F.col("message"), MESSAGE).alias("message"))


def scan_feed_messages(spark: SparkSession, path: str, fmt: str = "json",
                       endpoints: Collection[str] | None = None) -> DataFrame:
    """Stored messages, without those ``rejected_messages`` lists. JSON may name codes or number
    them, write numbers as text, and spell members either way.

    Of ``endpoints`` only, if named: which feed an endpoint has is told by a join, whose filter
    on it comes after a message has been built and looked through.
    """
    return _readable(spark.read, path, fmt, endpoints)


def endpoints_of(feed_type: str) -> list[str]:
    """The listed endpoints of a feed type."""
    return [endpoint for endpoint, kind, _ in ENDPOINTS if kind == feed_type]


def rejected_messages(spark: SparkSession, path: str) -> DataFrame:
    """What ``scan_feed_messages`` leaves out of JSON files, with the reason: lines that are no
    JSON of a message or have words where numbers belong, failed fetches, messages without a
    body. ``raw`` is the text of what could not be read."""
    reason = F.coalesce(*_no_message(True))
    return (_lines(spark.read, path)
            .select("endpoint", "received_at", "error", reason.alias("reason"),
                    F.col("_raw").alias("raw")).where(F.col("reason").isNotNull()))


def _no_message(with_raw: bool) -> list[Column]:
    lines = [F.when(F.col("_raw").isNotNull(), F.lit("unreadable line"))] if with_raw else []
    return [*lines, F.when(F.col("error").isNotNull(), F.lit("failed fetch")),
            F.when(F.col("message").isNull(), F.lit("no message"))]


def stream_feed_messages(spark: SparkSession, path: str, fmt: str = "json",
                         **options: str) -> DataFrame:
    """The same as a stream over files that keep arriving."""
    return _readable(spark.readStream, path, fmt, **options)


def stream_all_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Every line of JSON files that keep arriving, also those that cannot be read (``_raw``)
    and failed fetches; the ingest job lists what it refuses."""
    return _lines(spark.readStream, path, **options).withColumn(
        "message", F.when(F.col("_raw").isNull(), settled(F.col("message"), MESSAGE)))


def endpoints_dim(spark: SparkSession, transport_sources: DataFrame) -> DataFrame:
    """The seven endpoints with their source ids; an unknown source has a NULL id."""
    endpoints = inline_rows(spark, ["endpoint", "feed_type", "source_name"], ENDPOINTS)
    return endpoints.join(transport_sources.select("source_name", "source_id"),
                          "source_name", "left")


def unknown_endpoints(messages: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Messages whose endpoint is not listed or whose source has no id."""
    known = F.broadcast(endpoints.where("source_id is not null").select("endpoint"))
    return messages.join(known, "endpoint", "left_anti")


def feed_key(source_id: Column, feed_type: Column, received_at: Column) -> Column:
    """Stable id of a message, built from the columns that identify it."""
    return F.concat_ws(":", source_id.cast("string"), feed_type,
                       F.unix_micros(received_at).cast("string"))


def _stamped(messages: DataFrame, endpoints: DataFrame, versions: DataFrame, how: str) -> DataFrame:
    version = F.coalesce(active_version_id(versions),
                         F.raise_error(F.lit("no active version")).cast("int"))
    known = F.broadcast(endpoints.where("source_id is not null")
                        .select("endpoint", "feed_type", "source_id"))
    key = feed_key(F.col("source_id"), F.col("feed_type"), F.col("received_at"))
    return (messages.join(known, "endpoint", how)
            .withColumn("version_id", version)
            .withColumn("feed_message_id", key))


def tag_messages(messages: DataFrame, endpoints: DataFrame, versions: DataFrame) -> DataFrame:
    """Stamp messages with source, feed type, active version and key.

    The endpoint list has seven fixed rows, hence the broadcast. The active version is
    looked up each time the frame runs; that none is active is an error.
    """
    return _stamped(messages, endpoints, versions, "inner")


def _overflows(value: Column, kind) -> Column:
    return value.isNotNull() & value.cast("double").try_cast(kind).isNull()


def _not_a_stamp(value: Column) -> Column:
    return value.isNotNull() & posix_to_timestamp(value).isNull()


def _too_long(table: str, texts: dict[str, Column]) -> Column:
    """Whether one of ``texts``, by column, is longer than the table declares."""
    return _any(*[F.length(text) > MAX_LENGTH[table][column] for column, text in texts.items()])


def _any(*tests: Column) -> Column:
    """Whether one of the tests holds; one that is NULL does not."""
    held = F.lit(False)
    for test in tests:
        held = held | F.coalesce(test, F.lit(False))
    return held


def _in_vehicle(e: Column) -> tuple[Column, Column]:
    """Whether the entity gives a row of vehicle_positions, and whether its texts are too long."""
    v = e["vehicle"]
    return v.isNotNull() & v["position"].isNotNull(), _too_long("vehicle_positions", {
        "entity_id": e["id"], "trip_id": v["trip"]["trip_id"], "route_id": v["trip"]["route_id"],
        "vehicle_id": v["vehicle"]["id"], "vehicle_label": v["vehicle"]["label"],
        "license_plate": v["vehicle"]["license_plate"], "stop_id": v["stop_id"]})


def _in_trip_update(e: Column) -> tuple[Column, Column]:
    u = e["trip_update"]
    stop_ids = F.exists(u["stop_time_update"],
                        lambda s: _too_long("stop_time_updates", {"stop_id": s["stop_id"]}))
    return u["trip"]["trip_id"].isNotNull(), _any(stop_ids, _too_long("trip_updates", {
        "entity_id": e["id"], "trip_id": u["trip"]["trip_id"], "route_id": u["trip"]["route_id"],
        "vehicle_id": u["vehicle"]["id"], "vehicle_label": u["vehicle"]["label"]}))


TEXT_FIELDS = ["url", "header_text", "description_text"]


def _in_alert(e: Column) -> tuple[Column, Column]:
    a = e["alert"]
    named = F.exists(a["informed_entity"], lambda i: _too_long("alert_informed_entities", {
        "agency_id": i["agency_id"], "route_id": i["route_id"], "trip_id": i["trip"]["trip_id"],
        "trip_route_id": i["trip"]["route_id"], "stop_id": i["stop_id"]}))
    texts = [F.exists(a[f]["translation"], lambda t: _too_long(
        "alert_translations", {"language": t["language"]})) for f in TEXT_FIELDS]
    return a.isNotNull(), _any(named, *texts, _too_long("alerts", {"entity_id": e["id"]}))


def _repeats_a_stop(e: Column) -> Column:
    """Whether two stops of a trip update would share a key, defaults filled in."""
    keys = F.transform(e["trip_update"]["stop_time_update"], lambda s: F.struct(
        F.coalesce(s["stop_sequence"], F.lit(-1)), F.coalesce(s["stop_id"], F.lit(""))))
    return F.size(F.array_distinct(keys)) < F.size(keys)


def _lacks_a_text(e: Column) -> Column:
    return _any(*[F.exists(e["alert"][f]["translation"], lambda t: t["text"].isNull())
                  for f in TEXT_FIELDS])


def judge_messages(messages: DataFrame, endpoints: DataFrame, versions: DataFrame) -> DataFrame:
    """All ``messages``, tagged, with ``refusal``: why a message is not taken, NULL where it is.

    A message is taken whole or not at all: refused are lines that cannot be read, failed
    fetches, unknown endpoints and feed types, messages without header or time of receipt,
    entities without an id or with one that their message repeats, numbers and stamps outside
    their columns' range, and rows of its feed type that their table would not take: positions
    without coordinates, translations without a text, two stops of an update under one key,
    texts longer than declared. One bad message holds up no other. ``refuse_repeats`` looks
    for messages under one key.
    """
    m, kind = F.col("message"), F.col("feed_type")
    ids = F.transform(m["entity"], lambda e: e["id"])

    def any_entity(test) -> Column:
        return F.coalesce(F.exists(m["entity"], lambda e: F.coalesce(test(e), F.lit(False))), F.lit(False))

    def overflow(e: Column) -> Column:
        at = e["vehicle"]["position"]
        return (_overflows(at["latitude"], COORD) | _overflows(at["longitude"], COORD)
                | _overflows(at["bearing"], ANGLE))

    def bad_stamp(e: Column) -> Column:
        return _not_a_stamp(e["vehicle"]["timestamp"]) | _not_a_stamp(e["trip_update"]["timestamp"])

    def any_row(feed_type: str, rows, test) -> Column:
        """Whether a row the message gives a table of ``feed_type`` fails ``test``."""
        return (kind == feed_type) & any_entity(lambda e: rows(e)[0] & test(e))

    def no_place(e: Column) -> Column:
        at = e["vehicle"]["position"]
        return at["latitude"].isNull() | at["longitude"].isNull()

    feeds = {"vehicle_positions": _in_vehicle, "trip_updates": _in_trip_update,
             "service_alerts": _in_alert}
    long = [any_row(name, rows, lambda e, rows=rows: rows(e)[1]) for name, rows in feeds.items()]
    version = {"gtfs_realtime_version": m["header"]["gtfs_realtime_version"]}

    refusal = F.coalesce(
        *_no_message("_raw" in messages.columns),
        F.when(F.col("source_id").isNull(), F.lit("unknown endpoint")),
        F.when(~F.col("feed_type").isin(FEED_TYPES), F.lit("unknown feed type")),
        F.when(m["header"].isNull(), F.lit("no header")),
        F.when(F.col("received_at").isNull(), F.lit("no time of receipt")),
        F.when(F.exists(ids, lambda i: i.isNull()), F.lit("entity without id")),
        F.when(F.size(F.array_distinct(ids)) < F.size(ids), F.lit("repeated entity id")),
        F.when(any_entity(overflow), F.lit("number out of range")),
        F.when(_not_a_stamp(m["header"]["timestamp"]) | any_entity(bad_stamp),
               F.lit("stamp out of range")),
        F.when(any_row("vehicle_positions", _in_vehicle, no_place),
               F.lit("position without coordinates")),
        F.when(any_row("service_alerts", _in_alert, _lacks_a_text), F.lit("translation without text")),
        F.when(any_row("trip_updates", _in_trip_update, _repeats_a_stop), F.lit("repeated stop")),
        F.when(_any(*long, _too_long("feed_messages", version)), F.lit("text too long")))
    return _stamped(messages, endpoints, versions, "left").withColumn("refusal", refusal)


def refuse_repeats(judged: DataFrame, stored: DataFrame | None = None,
                   keep: Callable[[DataFrame], DataFrame] = lambda found: found) -> DataFrame:
    """``judged`` with a refusal for messages whose key (time of receipt, source, feed type) is
    taken: by a row of ``stored`` (feed_message_id), or by another message of the batch, of which
    the one with the smallest hash stays, whatever order they came in.

    Keys are looked up without the messages, in a job of their own: a batch that holds no such
    key, as most do, comes back as it is, and no message moves. What is found are keys and numbers of
    rows, which ``keep`` may persist: Spark then knows how few they are and brings them to the
    messages, else the messages of each table move to them. ``judged`` should be persisted.
    """
    key, free = "feed_message_id", F.col("refusal").isNull()

    def refused(rows: DataFrame, found: DataFrame, by: str, reason: str) -> DataFrame:
        return (rows.join(found.withColumn("_found", F.lit(True)), by, "left")
                .withColumn("refusal", F.when(free & F.col("_found"), F.lit(reason)).otherwise(F.col("refusal")))
                .drop("_found"))

    # Rows are numbered as they are stored, before any join could order them anew.
    plain, judged = judged, judged.withColumn("_row", F.monotonically_increasing_id())
    if stored is not None:
        held = keep(judged.where(free).select(key).join(stored, key, "left_semi").distinct())
        if held.count():
            plain, judged = [refused(x, held, key, "stored message") for x in (plain, judged)]
    twice = keep(judged.where(free).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                 .where("_n > 1").select(key))
    if not twice.count():
        return plain
    alike = judged.where(free).join(twice, key, "left_semi").select(
        key, "_row", F.xxhash64(F.to_json("message"), "endpoint").alias("_hash"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("_hash", "_row"))
    later = keep(alike.select("_row", place.alias("_place")).where("_place > 1").select("_row"))
    later.count()
    return refused(judged, later, "_row", "repeated message").drop("_row")


def refused_messages(judged: DataFrame) -> DataFrame:
    """The refused ones with their reason and text, as the ingest job keeps them."""
    text = F.to_json("message")
    raw = F.coalesce("_raw", text) if "_raw" in judged.columns else text
    return judged.where("refusal is not null").select(
        "endpoint", "received_at", F.col("refusal").alias("reason"), "error", raw.alias("raw"))
