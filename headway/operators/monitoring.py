"""Counts and ages that tell whether data keeps coming in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from headway.functions.clocks import AsOf, instant


def processor_stats(tagged: DataFrame) -> DataFrame:
    """Messages, entities of each kind and time of the last message, per feed type and source."""
    kind = lambda field: F.size(F.filter("message.entity", lambda e: e[field].isNotNull()))
    entities = F.coalesce(F.size("message.entity"), F.lit(0))
    return (tagged.select("feed_type", "source_id", "received_at", entities.alias("entities"),
                          kind("vehicle").alias("vehicles"), kind("trip_update").alias("trips"),
                          kind("alert").alias("alerts"))
            .groupBy("feed_type", "source_id")
            .agg(F.count(F.lit(1)).alias("messages"), F.sum("entities").alias("entities"),
                 F.sum("vehicles").alias("vehicle_positions"), F.sum("trips").alias("trip_updates"),
                 F.sum("alerts").alias("service_alerts"),
                 F.max("received_at").alias("last_processed")))


def feed_freshness(feed_messages: DataFrame, as_of: AsOf) -> DataFrame:
    """Newest message of each source and feed type, and its age in seconds."""
    age = F.unix_seconds(instant(as_of)) - F.unix_seconds("newest")
    return (feed_messages.groupBy("source_id", "feed_type").agg(F.max("received_at").alias("newest"))
            .withColumn("age_seconds", age))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, largest first."""
    parts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("table_name"), "records")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("records"), "table_name")
