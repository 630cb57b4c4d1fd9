"""Writing tables: versioned schedules, realtime batches, events, saved views."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from headway.functions.clocks import AsOf, instant
from headway.session import shared_dir

# Column each large table is spread and sorted by within its version and source, and what
# rows of one value are sorted by further.
CLUSTER = {"stop_times": ["stop_id", "departure_time_seconds"], "trips": ["trip_id"],
           "shapes": ["shape_id", "shape_pt_sequence"], "trip_ends": ["trip_id"]}
FOLDERS = ["version_id", "source_id"]

# Independent tables written at the same time, so that the last tasks of one do not leave the
# cluster idle.
AT_ONCE = 4


def write_side_by_side(spark: SparkSession, writes: list[Callable[[], None]]) -> None:
    """Run independent writes side by side; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]
    for write in running:
        write.result()


def write_version(tables: dict[str, DataFrame], root: str) -> None:
    """Write schedule tables under ``root/<table>/version_id=/source_id=``.

    Rows are rebalanced in one pass by version, source and cluster column: adaptive execution
    joins small partitions and splits large ones, so neither a source nor a stop that holds a
    third of all rows ends in one task. Files are sorted by the cluster column and carry a
    bloom filter on it, so a lookup skips most files and row groups.

    Only the (version, source) folders present are replaced, so a repeated load of one source
    leaves the others alone. Readers follow the versions table, whose row for this version is
    activated after all of this has succeeded.
    """
    def write(name: str) -> None:
        order = CLUSTER.get(name, [])
        laid = tables[name].hint("rebalance", *FOLDERS, *order[:1])
        writer = laid.sortWithinPartitions(*FOLDERS, *order).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic")
        if order:
            writer = writer.option(f"parquet.bloom.filter.enabled#{order[0]}", "true")
        writer.partitionBy(*FOLDERS).parquet(f"{root.rstrip('/')}/{name}")

    spark = next(iter(tables.values())).sparkSession
    write_side_by_side(spark, [partial(write, name) for name in tables])


def save_bucketed(tables: dict[str, DataFrame], database: str, buckets: int) -> None:
    """Save trip-keyed tables (stop times, trips, trip ends) bucketed by trip in the catalog.

    Boards and other whole-timetable jobs join these on source, version and trip. With equal
    buckets, and ``spark.sql.requireAllClusterKeysForCoPartition`` off in the job that reads
    them, those joins need no shuffle. The layout of ``write_version`` serves single stops better.
    """
    for name, df in tables.items():
        (df.repartition(buckets, "trip_id").write.mode("overwrite").partitionBy(*FOLDERS)
         .bucketBy(buckets, "trip_id").sortBy("trip_id").saveAsTable(f"{database}.{name}"))


def read_version_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}


def save_versions(versions: DataFrame, root: str, snapshot: int) -> None:
    """Write the whole (small) versions table as one new snapshot.

    A snapshot is one file, so it appears at once; readers take the highest one. One that is
    there already is an error: of two loads at once the second fails, nothing is overwritten.
    """
    (versions.coalesce(1).write.mode("error")
     .parquet(f"{root.rstrip('/')}/versions/snapshot={snapshot}"))


def load_versions(spark: SparkSession, root: str) -> DataFrame:
    saved = spark.read.parquet(f"{root.rstrip('/')}/versions")
    newest = saved.agg(F.max("snapshot")).scalar()
    return saved.where(F.col("snapshot") == newest).drop("snapshot")


def retired_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions that an earlier snapshot of the versions table lists and the newest does not."""
    saved = spark.read.parquet(f"{root.rstrip('/')}/versions").select("version_id").distinct()
    kept = load_versions(spark, root).select("version_id")
    return sorted(r["version_id"] for r in saved.join(kept, "version_id", "left_anti").collect())


def write_batch(tables: dict[str, DataFrame], root: str, batch_id: int) -> None:
    """Write the rows of one micro-batch, children first.

    Each table's folder for this batch is replaced, so a batch that is run again after a
    failure leaves no duplicates. Readers that start from ``feed_messages`` (written last)
    only see batches that are whole.
    """
    def write(name: str) -> None:
        tables[name].write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}/batch_id={batch_id}")

    spark = next(iter(tables.values())).sparkSession
    write_side_by_side(spark, [partial(write, name) for name in tables if name != "feed_messages"])
    if "feed_messages" in tables:
        write("feed_messages")


def stored_folder(spark: SparkSession, folder: str) -> bool:
    """Whether there is such a folder, on whatever file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def whole_folders(spark: SparkSession, root: str, column: str) -> list[int]:
    """Numbers of the folders ``column=number`` whose write has ended, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{column}=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def folder_numbers(spark: SparkSession, root: str, column: str) -> list[int]:
    """Numbers of all folders ``column=number`` below ``root``, whole or not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{column}=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [int(f.getPath().getName().split("=")[1]) for f in found]


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete stored folders on whatever file system they are; one that is gone is no error."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Books of folded days: live batches with their day and the bounds of their stamps, and those gone.
BOOKS = "batch_id long, day date, last timestamp, undated long, live boolean"


def fold_books(spark: SparkSession, root: str) -> DataFrame:
    """The newest whole books that ``plans.folding`` keeps of stored batches; empty without any."""
    folds = whole_folders(spark, f"{root.rstrip('/')}/folds", "fold")
    if not folds:
        return spark.createDataFrame([], BOOKS)
    return spark.read.schema(BOOKS).parquet(f"{root.rstrip('/')}/folds/fold={folds[-1]}")


def read_batches(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """Stored realtime tables, whole batches only.

    ``feed_messages``, which a batch writes last, is listed first; rows of batches it does not
    know belong to a batch that is still being written. The books of folded days are read
    before: batches they call gone, and folded ones they do not know yet, are left out.
    """
    books = fold_books(spark, root).select("batch_id", "live").collect()
    gone = [r["batch_id"] for r in books if not r["live"]]
    folded = [r["batch_id"] for r in books if r["live"] and r["batch_id"] < 0]
    number = F.col("batch_id")
    seen = ((number >= 0) | number.isin(folded)) & ~number.isin(gone)
    feeds = spark.read.parquet(f"{root.rstrip('/')}/feed_messages").where(seen)
    whole = feeds.select("batch_id").distinct()
    found = {"feed_messages": feeds}
    for name in names:
        if name not in found:
            found[name] = (spark.read.parquet(f"{root.rstrip('/')}/{name}").where(seen)
                           .join(whole, "batch_id", "left_semi"))
    return found


# Parents go before their children, messages last: what a run that broke off has left is found
# by the next one.
REWRITE_ORDER = ["trip_updates", "alerts", "vehicle_positions", "stop_time_updates",
                 "alert_active_periods", "alert_informed_entities", "alert_translations",
                 "feed_messages"]


def keep_rows(root: str, live: dict[str, DataFrame], kept: dict[str, DataFrame]) -> None:
    """Bring stored tables (``live``, from ``read_batches``) to the rows of ``kept``, in place.

    Only batches that lose rows are touched: their remaining rows are written aside first and
    then replace the folder; batches that lose all are deleted. Batches written meanwhile are left
    alone. The driver sees the numbers of the changed batches, one per folder it replaces.
    """
    spark = live["feed_messages"].sparkSession
    names = [n for n in REWRITE_ORDER if n in kept]

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("batch_id").agg(F.count(F.lit(1)).alias(name))

    changed, staged = {}, {}
    for name in names:
        compared = rows(live[name], "had").join(rows(kept[name], "stay"), "batch_id", "left")
        changed[name] = {r["batch_id"]: r["stay"] for r in compared.select(
            "batch_id", "had", F.coalesce("stay", F.lit(0)).alias("stay"))
            .where("had <> stay").collect()}
        halved = [b for b, stay in changed[name].items() if stay]
        if halved:
            staged[name] = shared_dir(spark, f"kept-{name}")
            number = T.StructType([live[name].schema["batch_id"]])
            part = spark.createDataFrame([(b,) for b in halved], number)
            (kept[name].join(part, "batch_id", "left_semi").hint("rebalance", "batch_id")
             .write.partitionBy("batch_id").parquet(staged[name]))
    emptied = {name: sorted(b for b, stay in changed[name].items() if not stay) for name in names}
    bare = {name for name in names if emptied[name] and kept[name].isEmpty()}
    for name in names:
        table = f"{root.rstrip('/')}/{name}"
        if name in staged:
            (spark.read.parquet(staged[name]).hint("rebalance", "batch_id").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(table))
        if name in bare:  # an empty file stays, so that the table can be read
            nothing = spark.createDataFrame([], live[name].drop("batch_id").schema)
            nothing.write.mode("overwrite").parquet(f"{table}/batch_id={emptied[name].pop()}")
        drop_folders(spark, [f"{table}/batch_id={b}" for b in emptied[name]])


def publish_events(events: DataFrame, path: str, fmt: str = "parquet",
                   batch_id: int | None = None, **options: str) -> None:
    """Write (channel, payload, event_time) rows to a table of files, or to Kafka with the
    channel as key. With ``batch_id`` files are written to the batch's own folder, so a batch
    that is published again replaces itself; without it they are appended."""
    if fmt == "kafka":
        events = events.select(F.col("channel").alias("key"), F.col("payload").alias("value"))
        events.write.format("kafka").options(**options).save()
    elif batch_id is not None:
        (events.write.mode("overwrite").format(fmt).options(**options)
         .save(f"{path.rstrip('/')}/batch_id={batch_id}"))
    else:
        events.write.mode("append").format(fmt).options(**options).save(path)


def refresh_views(spark: SparkSession, root: str, views: dict[str, Callable[[], DataFrame]],
                  as_of: AsOf) -> DataFrame:
    """Recompute saved views; one status row per view with the seconds it took.

    Each refresh is a snapshot of its own, beside the one readers hold: a running or failed
    refresh leaves them that, and does not stop the other views. ``load_view`` reads the newest.
    """
    rows = []
    for name in sorted(views):
        started = time.time_ns()
        try:
            views[name]().write.mode("error").parquet(
                f"{root.rstrip('/')}/{name}/snapshot={started // 1000}")
            status = "SUCCESS"
        except Exception as problem:  # reported, as the caller refreshes several views
            status = f"ERROR: {problem}"
        rows.append((name, status, (time.time_ns() - started) / 1e9))
    report = spark.createDataFrame(
        rows, "view_name string, refresh_status string, duration_seconds double")
    return report.withColumn("refreshed_at", instant(as_of))


def load_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest whole snapshot of a saved view."""
    saved = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    newest = saved.agg(F.max("snapshot")).scalar()
    return saved.where(F.col("snapshot") == newest).drop("snapshot")
