"""Small batches of closed days folded into few larger ones, and whole days dropped unread.

A fold writes new batches (numbers below zero, counted down) beside those they replace and then
commits a snapshot of its books, ``folds/fold=N``; ``sinks.read_batches`` reads the newest whole
snapshot first, so a reader sees the old batches or the new ones, never both. What a snapshot lists as
gone is deleted by the next fold or drop, so a reader that began before it keeps its files.
A fold that broke off has committed nothing: its batches stay unseen and the next one deletes them.
One fold or drop runs at a time, and neither beside ``keep_rows``; ingest and readers go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from headway.functions.clocks import AsOf, instant
from headway.schemas import REALTIME_TABLES
from headway.sources import sinks

# A fold aims at batches of this many rows over all tables.
TARGET_ROWS = 20_000_000


def _delete_gone(spark: SparkSession, root: str, books: DataFrame) -> None:
    """Delete what the newest books call gone, and new batches that no books know."""
    live = {r["batch_id"] for r in books.where("live").select("batch_id").collect()}
    gone = [r["batch_id"] for r in books.where("not live").select("batch_id").collect()]
    for name in REALTIME_TABLES:
        lost = [b for b in sinks.folder_numbers(spark, f"{root}/{name}", "batch_id")
                if b < 0 and b not in live]
        sinks.drop_folders(spark, [f"{root}/{name}/batch_id={b}" for b in {*gone, *lost}])


def _batches(live: dict[str, DataFrame]) -> DataFrame:
    """``batch_id`` with its day, the bounds of its messages' stamps and its rows in all tables.

    The last day on which a message came in is the batch's day. Of the other tables only
    folders and footers are read, as nothing but rows is counted.
    """
    one = F.count(F.lit(1)).alias("n")
    counts = [live[n].groupBy("batch_id").agg(one) for n in REALTIME_TABLES]
    whole = counts[0]
    for part in counts[1:]:
        whole = whole.unionByName(part)
    whole = whole.groupBy("batch_id").agg(F.sum("n").alias("n"))
    return (live["feed_messages"].groupBy("batch_id")
            .agg(F.to_date(F.max("received_at")).alias("day"), F.max("timestamp").alias("last"),
                 F.count_if(F.col("timestamp").isNull()).alias("undated"))
            .join(whole, "batch_id"))


def _commit(spark: SparkSession, root: str, books: DataFrame) -> None:
    """Books appear at once: readers take only folders whose write has ended."""
    folds = sinks.folder_numbers(spark, f"{root}/folds", "fold")
    books.coalesce(1).write.mode("error").parquet(f"{root}/folds/fold={max(folds, default=0) + 1}")


def _kept_books(spark: SparkSession, root: str) -> DataFrame:
    """The newest books, without what was gone by then (deleted here)."""
    books = sinks.fold_books(spark, root)
    _delete_gone(spark, root, books)
    return books.where("live")


def fold_days(spark: SparkSession, root: str, as_of: AsOf, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Fold the batches of days before that of ``as_of``; returns ``day, had, has``: the batches of
    each such day before and after.

    Batches of a day meet in the order of their numbers until ``target_rows`` is reached; those that
    came late join the day's smaller ones next time. A batch that is large enough alone stays where
    it is. The newest batch is left alone, as its job may run it again.
    """
    root = root.rstrip("/")
    known = _kept_books(spark, root)
    live = sinks.read_batches(spark, root, REALTIME_TABLES)
    newest = live["feed_messages"].agg(F.max("batch_id")).scalar()
    closed = _batches(live).where((F.col("batch_id") < newest)
                                  & (F.col("day") < F.to_date(instant(as_of))))
    # Rows of the batches before this one in its day, without those large enough alone.
    small = F.col("n") < target_rows
    before = F.sum(F.when(small, F.col("n")).otherwise(0)).over(
        W.partitionBy("day").orderBy("batch_id").rowsBetween(W.unboundedPreceding, -1))
    bins = closed.withColumn("bin", F.when(
        small, F.floor(F.coalesce(before, F.lit(0)) / F.lit(target_rows))))
    same = W.partitionBy("day", "bin")
    bins = bins.withColumn("members", F.when(small, F.count(F.lit(1)).over(same)).otherwise(1))
    # One row per batch of closed days; the driver names the folders they go to, as it lists them.
    rows = bins.orderBy("day", "bin", "batch_id").collect()
    lowest = min((b for n in REALTIME_TABLES
                  for b in sinks.folder_numbers(spark, f"{root}/{n}", "batch_id")), default=0)
    number, home, moves, books = min(lowest, 0), {}, [], {}
    for r in rows:
        at = r["batch_id"]
        if r["members"] > 1:
            if (r["day"], r["bin"]) not in home:
                number -= 1
                home[r["day"], r["bin"]] = number
            at = home[r["day"], r["bin"]]
            moves.append((r["batch_id"], at))
        day, last, undated = books.get(at, (r["day"], None, 0))
        stamps = [s for s in (last, r["last"]) if s is not None]
        books[at] = (day, max(stamps, default=None), undated + r["undated"])
    if moves:
        spread = spark.createDataFrame(moves, "batch_id long, new_batch long")
        old = [b for b, _ in moves]
        sinks.write_side_by_side(spark, [
            lambda name=name: (live[name].where(F.col("batch_id").isin(old)).join(spread, "batch_id")
                               .drop("batch_id").withColumnRenamed("new_batch", "batch_id")
                               .hint("rebalance", "batch_id").sortWithinPartitions("batch_id")
                               .write.mode("append").partitionBy("batch_id").parquet(f"{root}/{name}"))
            for name in REALTIME_TABLES])
    moved = {b for b, _ in moves}
    there = set(sinks.folder_numbers(spark, f"{root}/feed_messages", "batch_id"))
    kept = [r for r in known.collect() if r["batch_id"] in there - moved - set(books)]
    lines = [(at, *facts, True) for at, facts in books.items()]
    lines += [tuple(r) for r in kept] + [(b, None, None, None, False) for b in sorted(moved)]
    _commit(spark, root, spark.createDataFrame(lines, sinks.BOOKS))
    days = [(r["day"], r["batch_id"], home.get((r["day"], r["bin"]), r["batch_id"])
             if r["members"] > 1 else r["batch_id"]) for r in rows]
    return (spark.createDataFrame(days, "day date, old long, new long").groupBy("day")
            .agg(F.count_distinct("old").alias("had"), F.count_distinct("new").alias("has")))


def drop_days(spark: SparkSession, root: str, limit: AsOf) -> DataFrame:
    """Drop the closed batches all of whose messages are stamped before ``limit``, unread; returns
    ``table_name, records_deleted``, counted from the files' footers.

    It removes what ``keep_feed_messages`` and its cascade would, batch by batch; batches that are
    partly older, or that no fold has entered in the books, are left to ``clean_realtime``.
    """
    root = root.rstrip("/")
    known = _kept_books(spark, root)
    live = sinks.read_batches(spark, root, REALTIME_TABLES)
    old = (F.col("last") < instant(limit)) & (F.col("undated") == 0)
    doomed = [r["batch_id"] for r in known.where(old).select("batch_id").collect()]
    report = None
    for name in REALTIME_TABLES:
        gone = live[name].where(F.col("batch_id").isin(doomed)).agg(
            F.count(F.lit(1)).alias("records_deleted"))
        gone = gone.select(F.lit(name).alias("table_name"), "records_deleted")
        report = gone if report is None else report.unionByName(gone)
    report = spark.createDataFrame(report.collect(), report.schema)  # one row a table
    if doomed:
        hidden = F.col("batch_id").isin(doomed)
        books = known.withColumn("live", ~hidden)
        _commit(spark, root, spark.createDataFrame(books.collect(), sinks.BOOKS))
    return report
