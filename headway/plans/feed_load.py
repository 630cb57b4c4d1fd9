"""Turning realtime messages into tables and events, one batch at a time."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from headway.functions.clocks import AsOf
from headway.operators.events import message_events
from headway.operators.realtime_rows import REALTIME_ROWS
from headway.sources.feeds import judge_messages, refuse_repeats, refused_messages
from headway.sources.sinks import stored_folder, write_batch


def realtime_tables(tagged: DataFrame) -> dict[str, DataFrame]:
    return {name: rows(tagged) for name, rows in REALTIME_ROWS.items()}


@contextmanager
def _judged(messages: DataFrame, endpoints: DataFrame, versions: DataFrame) -> Iterator[DataFrame]:
    """The judged batch, read once and kept while its tables are written. Executors that are
    lost read their part again from the source."""
    judged = judge_messages(messages, endpoints, versions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield judged
    finally:
        judged.unpersist()


def _stored_keys(judged: DataFrame, root: str, batch_id: int) -> DataFrame | None:
    """Keys of the messages that other batches hold from the time this one covers; the bounds
    reach the scan, so files of other times are skipped."""
    spark, folder = judged.sparkSession, f"{root.rstrip('/')}/feed_messages"
    covered = judged.where("refusal is null").agg(F.min("received_at").alias("first"),
                                                  F.max("received_at").alias("last")).first()
    if covered["first"] is None or not stored_folder(spark, folder):
        return None
    held = spark.read.parquet(folder)
    return (held.where((F.col("batch_id") != batch_id)
                       & F.col("received_at").between(covered["first"], covered["last"]))
            .select("feed_message_id"))


def load_messages(messages: DataFrame, endpoints: DataFrame, versions: DataFrame, root: str,
                  batch_id: int) -> None:
    """Flatten a batch of messages and write its eight tables, and beside them
    ``rejected_messages``: what was refused, and why.

    A message that an earlier batch holds, as when a file arrives again under a new name, is
    refused; the batch itself may be run again. Jobs that write to one ``root`` at the same
    moment do not see each other's messages.
    """
    with _judged(messages, endpoints, versions) as judged, ExitStack() as kept:
        def keep(found: DataFrame) -> DataFrame:
            kept.callback(found.persist(StorageLevel.MEMORY_AND_DISK).unpersist)
            return found

        judged = refuse_repeats(judged, _stored_keys(judged, root, batch_id), keep)
        tables = realtime_tables(judged.where("refusal is null"))
        write_batch({**tables, "rejected_messages": refused_messages(judged)}, root, batch_id)


def load_events(messages: DataFrame, endpoints: DataFrame, versions: DataFrame, root: str,
                batch_id: int, as_of: AsOf) -> None:
    """Write the events of the messages of a batch that are not refused. Nothing is shuffled, so
    a message that comes twice is told twice."""
    with _judged(messages, endpoints, versions) as judged:
        events = message_events(judged.where("refusal is null"), as_of)
        write_batch({"events": events}, root, batch_id)
