"""Structured Streaming jobs. Each starts a query and returns it.

``trigger`` defaults to working off what is there and stopping; pass
``{"processingTime": "30 seconds"}`` to keep a job running.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions.clocks import AsOf, posix_to_timestamp
from headway.operators.realtime_rows import vehicle_positions
from headway.plans.feed_load import load_events, load_messages
from headway.sources.feeds import tag_messages
from headway.sources.sinks import drop_folders, whole_folders

DRAIN = {"availableNow": True}
Lookup = Callable[[], DataFrame]


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
           trigger: dict, mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.outputMode(mode).foreachBatch(each)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or DRAIN)).start())


def _replace(root: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to its own folder, replacing what an earlier attempt left."""
    return lambda batch, n: (batch.write.mode("overwrite")
                             .parquet(f"{root.rstrip('/')}/batch_id={n}"))


def ingest_feeds(messages: DataFrame, endpoints: DataFrame, versions: Lookup, root: str,
                 checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Messages to the eight realtime tables; the active version is looked up per batch."""
    return _start(messages, lambda batch, n: load_messages(batch, endpoints, versions(), root, n),
                  checkpoint, trigger)


def event_stream(messages: DataFrame, endpoints: DataFrame, versions: Lookup, root: str,
                 checkpoint: str, as_of: AsOf | None = None,
                 trigger: dict | None = None) -> StreamingQuery:
    """Messages to change events. All parents of a row are in its own message, so nothing is
    joined or shuffled and no state is kept between batches."""
    def each(batch: DataFrame, n: int) -> None:
        now = F.current_timestamp() if as_of is None else as_of
        load_events(batch, endpoints, versions(), root, n, now)
    return _start(messages, each, checkpoint, trigger)


def latest_vehicle(messages: DataFrame, endpoints: DataFrame, versions: DataFrame, root: str,
                   checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The newest position of each vehicle; every batch writes the vehicles it changed.

    State is one row per vehicle. Partial maxima are taken before the shuffle.
    """
    tagged = tag_messages(messages, endpoints, versions)
    rows = vehicle_positions(tagged, "source_id").where("vehicle_id is not null")
    facts = F.struct("trip_id", "route_id", "latitude", "longitude", "current_status", "stop_id",
                     "timestamp")
    newest = (rows.groupBy("source_id", "vehicle_id")
              .agg(F.max_by(facts, F.struct("timestamp", "vehicle_position_id")).alias("p"))
              .select("source_id", "vehicle_id", "p.*"))
    return _start(newest, _replace(root), checkpoint, trigger, "update")


def windowed_activity(messages: DataFrame, endpoints: DataFrame, versions: DataFrame, root: str,
                      checkpoint: str, length: str = "1 hour", slide: str = "30 minutes",
                      late: str = "1 hour", trigger: dict | None = None) -> StreamingQuery:
    """Trip updates per trip in sliding windows of the time they were received."""
    tagged = tag_messages(messages, endpoints, versions).withWatermark("received_at", late)
    rows = (tagged.where("feed_type = 'trip_updates'")
            .select("source_id", "received_at", F.explode("message.entity").alias("e"))
            .where("e.trip_update.trip.trip_id is not null")
            .select("source_id", "received_at", F.col("e.trip_update.trip.trip_id").alias("trip_id")))
    counts = (rows.groupBy(F.window("received_at", length, slide), "source_id", "trip_id")
              .agg(F.count(F.lit(1)).alias("updates"))
              .select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "source_id", "trip_id", "updates"))
    return _start(counts, _replace(root), checkpoint, trigger, "update")


def distinct_entities(messages: DataFrame, endpoints: DataFrame, versions: DataFrame, root: str,
                      checkpoint: str, retention: str = "1 day",
                      trigger: dict | None = None) -> StreamingQuery:
    """Entities without repeats of the same message; state is dropped after ``retention``.

    Off in the plain load, which keeps repeats: a cached message is sent again as it was.
    """
    tagged = tag_messages(messages, endpoints, versions).withWatermark("received_at", retention)
    entities = tagged.select(
        "source_id", "feed_type", "received_at",
        posix_to_timestamp(F.col("message.header.timestamp")).alias("message_time"),
        F.explode("message.entity").alias("e")
    ).select("source_id", "feed_type", "received_at", "message_time", F.col("e.id").alias("entity_id"))
    once = entities.dropDuplicatesWithinWatermark(
        ["source_id", "feed_type", "message_time", "entity_id"])
    return _start(once, _replace(root), checkpoint, trigger)


def _newest(rows: DataFrame, key: list[str]) -> DataFrame:
    facts = F.struct(*[c for c in rows.columns if c not in (*key, "batch_id")])
    return (rows.groupBy(*key)
            .agg(F.max_by(facts, "batch_id").alias("f"), F.max("batch_id").alias("batch_id"))
            .select(*key, "f.*", "batch_id"))


def _folded(root: str) -> str:
    return f"{root.rstrip('/')}_folded"


def _log(spark: SparkSession, root: str, key: list[str]) -> tuple[DataFrame, list[int], list[int]]:
    """Rows of the newest fold and of the whole batches after it; numbers of those batches and of
    the folds. A fold is one row per key with the batch it was written in."""
    folds = whole_folders(spark, _folded(root), "upto")
    since = folds[-1] if folds else -1
    after = [n for n in whole_folders(spark, root, "batch_id") if n > since]
    parts = [spark.read.parquet(f"{_folded(root)}/upto={since}")] if folds else []
    if after:
        parts.append(spark.read.option("basePath", root).parquet(
            *[f"{root.rstrip('/')}/batch_id={n}" for n in after])
            .withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if not parts:
        raise ValueError(f"no whole batch in {root}")
    return reduce(DataFrame.unionByName, parts), after, folds


def latest_per_key(spark: SparkSession, root: str, key: list[str]) -> DataFrame:
    """What an update-mode job has written: the last row of each key. Only the newest fold
    (``fold_latest``) and the batches after it are read; one that is being written is not."""
    return _newest(_log(spark, root, key)[0], key).drop("batch_id")


def fold_latest(spark: SparkSession, root: str, key: list[str]) -> int:
    """Fold what an update-mode job has written into one row per key; the number of batches it
    took in. The job may go on meanwhile.

    The fold lies beside the batches and counts from when it is whole. Batches and folds it stands
    in for stay until the next fold, for readers that hold them; what a run that broke off has
    left, before or after its fold was whole, changes no result and goes with the next fold.
    What is kept is bounded by the keys and the batches of two runs.
    """
    rows, after, folds = _log(spark, root, key)
    if not after:
        return 0
    target = f"{_folded(root)}/upto={after[-1]}"
    _newest(rows, key).hint("rebalance").write.mode("overwrite").parquet(target)
    before = folds[-1] if folds else -1
    drop_folders(spark, [f"{_folded(root)}/upto={n}" for n in folds[:-1]] + [
        f"{root.rstrip('/')}/batch_id={n}"
        for n in whole_folders(spark, root, "batch_id") if n <= before])
    return len(after)


def latest_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest position of each vehicle as a ``latest_vehicle`` job holds it in its state,
    read from its checkpoint; nothing the job has written is read."""
    state = spark.read.format("statestore").load(checkpoint)
    best = next(f.name for f in state.schema["value"].dataType
                if f.dataType.typeName() == "struct" and "latitude" in f.dataType.names)
    return state.select("key.*", F.col(f"value.{best}.*"))
