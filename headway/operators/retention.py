"""What old realtime data may go, what stays, and how much that was.

``keep_*`` functions return the rows that stay, ``drop_*`` functions the others. Deleting is
writing back what stays, or dropping whole partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.clocks import AsOf, day_age, instant
from headway.operators.parents import to_parent

Live = dict[str, DataFrame]

# Report words of the data age check.
AGE_METRIC = "Oldest Real-time Data"
ADVICE = {"WARNING": "Run cleanup with a retention of 7 days",
          "CAUTION": "Consider running cleanup soon",
          "OK": "Data freshness is good"}


def cutoff(as_of: AsOf, retention_days: int) -> Column:
    return instant(as_of) - F.make_dt_interval(F.lit(retention_days))


def _older(column: str, limit: Column) -> Column:
    return F.coalesce(F.col(column) < limit, F.lit(False))


def keep_trip_updates(trip_updates: DataFrame, limit: Column) -> DataFrame:
    """Updates without a timestamp stay."""
    return trip_updates.where(~_older("timestamp", limit))


def drop_trip_updates(trip_updates: DataFrame, limit: Column) -> DataFrame:
    return trip_updates.where(_older("timestamp", limit))


def trip_update_slices(trip_updates: DataFrame, limit: Column, batch_seconds: int) -> DataFrame:
    """Dropped updates per time slice of ``batch_seconds``, counted from the oldest one."""
    doomed = drop_trip_updates(trip_updates, limit)
    oldest = F.unix_micros(doomed.agg(F.min("timestamp")).scalar())
    position = F.floor((F.unix_micros("timestamp") - oldest) / F.lit(batch_seconds * 1_000_000))
    return (doomed.groupBy((position + 1).cast("int").alias("batch_number"))
            .agg(F.count(F.lit(1)).alias("records_deleted")))


def keep_children(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return to_parent(children, parents, key, how="left_semi")


def drop_children(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose parent is gone."""
    return to_parent(children, parents, key, how="left_anti")


def keep_feed_messages(feed_messages: DataFrame, limit: Column,
                       clock: str = "timestamp") -> DataFrame:
    """``clock`` is ``timestamp``, or ``received_at`` for the short 15-minute form."""
    return feed_messages.where(~_older(clock, limit))


def drop_feed_messages(feed_messages: DataFrame, limit: Column,
                       clock: str = "timestamp") -> DataFrame:
    return feed_messages.where(_older(clock, limit))


def drop_vehicle_positions(positions: DataFrame, feed_messages: DataFrame,
                           limit: Column) -> DataFrame:
    """Positions whose message is too old."""
    return keep_children(positions, drop_feed_messages(feed_messages, limit), "feed_message_id")


def keep_vehicle_positions(positions: DataFrame, feed_messages: DataFrame,
                           limit: Column) -> DataFrame:
    return drop_children(positions, drop_feed_messages(feed_messages, limit), "feed_message_id")


def expired_alerts(alert_active_periods: DataFrame, limit: Column, as_of: AsOf) -> DataFrame:
    """Alerts with at least one period, all of which ended before ``limit``.

    An open end counts as now, so the latest end decides.
    """
    end = F.coalesce("end_time", F.unix_seconds(instant(as_of)))
    return (alert_active_periods.groupBy("alert_id").agg(F.max(end).alias("last_end"))
            .where(F.col("last_end") < F.unix_seconds(limit)).select("alert_id"))


def cascade(live: Live, feeds: DataFrame) -> Live:
    """All realtime tables once only ``feeds`` are left of the messages."""
    kept = {"feed_messages": feeds}
    for name in ("vehicle_positions", "trip_updates", "alerts"):
        kept[name] = keep_children(live[name], feeds, "feed_message_id")
    kept["stop_time_updates"] = keep_children(
        live["stop_time_updates"], kept["trip_updates"], "trip_update_id")
    for name in ("alert_active_periods", "alert_informed_entities", "alert_translations"):
        if name in live:
            kept[name] = keep_children(live[name], kept["alerts"], "alert_id")
    return kept


def after_cleanup(live: Live, as_of: AsOf, retention_days: int = 7) -> Live:
    """All realtime tables as a cleanup leaves them: old trip updates, expired alerts and old
    messages are gone, and with each its children."""
    limit = cutoff(as_of, retention_days)
    expired = expired_alerts(live["alert_active_periods"], limit, as_of)
    left = {**live, "trip_updates": keep_trip_updates(live["trip_updates"], limit),
            "alerts": live["alerts"].join(expired, "alert_id", "left_anti")}
    return cascade(left, keep_feed_messages(live["feed_messages"], limit))


def _row(table: str, batch: int, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("records_deleted")).select(
        F.lit(table).alias("table_name"), F.lit(batch).alias("batch_number"), "records_deleted")


def cleanup_report(live: Live, as_of: AsOf, retention_days: int = 7,
                   batch_seconds: int = 10000) -> DataFrame:
    """Rows removed per table; batch 0 is a table's total, trip updates also list slices.

    Alerts and messages are removed in one step and reported as batch 1.
    """
    limit = cutoff(as_of, retention_days)
    slices = (trip_update_slices(live["trip_updates"], limit, batch_seconds)
              .select(F.lit("trip_updates").alias("table_name"), "batch_number", "records_deleted"))
    kept = keep_trip_updates(live["trip_updates"], limit)
    expired = keep_children(live["alerts"],
                            expired_alerts(live["alert_active_periods"], limit, as_of), "alert_id")
    return reduce(DataFrame.unionByName, [
        slices,
        _row("trip_updates", 0, drop_trip_updates(live["trip_updates"], limit)),
        _row("stop_time_updates", 0,
             drop_children(live["stop_time_updates"], kept, "trip_update_id")),
        _row("vehicle_positions", 0,
             drop_vehicle_positions(live["vehicle_positions"], live["feed_messages"], limit)),
        _row("alerts", 1, expired),
        _row("feed_messages", 1, drop_feed_messages(live["feed_messages"], limit))])


def cleanup_summary(live: Live, as_of: AsOf, retention_days: int = 7) -> DataFrame:
    """Totals per table, from the summary rows of the report only."""
    return (cleanup_report(live, as_of, retention_days, 5000).where("batch_number = 0")
            .groupBy("table_name").agg(F.sum("records_deleted").alias("records_deleted")))


def rows_by_source(live: Live) -> DataFrame:
    """Rows of each source in each of the five main tables.

    Children are first counted per parent, then per message, so that neither join sees more
    than one row per key on its counted side.
    """
    feeds = live["feed_messages"].select("feed_message_id", "source_id")
    one = F.count(F.lit(1)).alias("n")

    def per_message(name: str) -> DataFrame:
        return live[name].groupBy("feed_message_id").agg(one)

    def per_source(name: str, counts: DataFrame) -> DataFrame:
        return (counts.join(feeds, "feed_message_id").groupBy("source_id")
                .agg(F.sum("n").alias("records"))
                .select(F.lit(name).alias("data_type"), "source_id", "records"))

    stop_rows = (live["stop_time_updates"].groupBy("trip_update_id").agg(one)
                 .join(live["trip_updates"].select("trip_update_id", "feed_message_id"),
                       "trip_update_id")
                 .groupBy("feed_message_id").agg(F.sum("n").alias("n")))
    parts = [per_source(n, per_message(n)) for n in ("vehicle_positions", "trip_updates", "alerts")]
    parts.append(per_source("stop_time_updates", stop_rows))
    parts.append(per_source("feed_messages", feeds.groupBy("feed_message_id").agg(one)))
    return reduce(DataFrame.unionByName, parts)


def without_source(live: Live, name: str, source_id: int) -> DataFrame:
    """One of the five main tables without the rows of one source."""
    feeds = live["feed_messages"].where(F.col("source_id") == source_id).select("feed_message_id")
    if name == "feed_messages":
        return live[name].where(F.col("source_id") != source_id)
    if name == "stop_time_updates":
        doomed = keep_children(live["trip_updates"], feeds, "feed_message_id")
        return drop_children(live[name], doomed, "trip_update_id")
    return drop_children(live[name], feeds, "feed_message_id")


def purge_report(live: Live) -> DataFrame:
    """Rows a full purge removes from each realtime table."""
    return reduce(DataFrame.unionByName, [
        _row(name, 0, df).drop("batch_number") for name, df in live.items()])


def data_age_health(trip_updates: DataFrame, as_of: AsOf) -> DataFrame:
    """Age of the oldest trip update, with a status and an advice."""
    age = day_age(as_of, F.col("oldest"))
    status = F.when(F.col("days") > 30, "WARNING").when(F.col("days") > 7, "CAUTION").otherwise("OK")
    advice = F.create_map(*[F.lit(x) for pair in ADVICE.items() for x in pair])
    return (trip_updates.agg(F.min("timestamp").alias("oldest"))
            .select(F.lit(AGE_METRIC).alias("metric"), age.alias("days"))
            .select("metric", F.concat(F.col("days").cast("string"), F.lit(" days ago")).alias("value"),
                    status.alias("status"))
            .withColumn("recommendation", advice[F.col("status")]))
