"""Regular upkeep of stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.functions.clocks import AsOf
from headway.operators.retention import (
    Live, after_cleanup, cascade, cleanup_report, purge_report, rows_by_source, without_source)
from headway.operators.versions import delete_versions, versions_to_delete, without_versions
from headway.plans.schedule_load import newest_snapshot, saved_views
from headway.schemas import REALTIME_TABLES, STATIC_TABLES
from headway.session import shared_dir
from headway.sources import sinks

SOURCE_TABLES = ("vehicle_positions", "trip_updates", "stop_time_updates", "alerts", "feed_messages")


def after_import(spark: SparkSession, warehouse: str, as_of: AsOf,
                 keep: int = 1) -> tuple[DataFrame, DataFrame]:
    """Refresh the saved views and retire old versions; returns both reports.

    A retired version leaves the versions table, which all readers follow; then its folders are
    deleted. A run that broke off in between is made up for by the next one, as the snapshots of
    the versions table tell what has left it. Not to be run beside a load.
    """
    views = saved_views(spark, warehouse, as_of)
    versions = sinks.load_versions(spark, warehouse)
    tables = sinks.read_version_tables(spark, warehouse, STATIC_TABLES)
    report = delete_versions(versions, tables, keep)
    remaining = without_versions(versions, versions_to_delete(versions, keep))
    # The report is of the versions as they were: it is kept before they change.
    path = f"{warehouse.rstrip('/')}/reports/versions/snapshot={newest_snapshot(spark, warehouse) + 1}"
    report.write.mode("overwrite").parquet(path)
    sinks.save_versions(remaining, warehouse, newest_snapshot(spark, warehouse) + 1)
    sinks.drop_folders(spark, [f"{warehouse.rstrip('/')}/{name}/version_id={version}"
                               for version in sinks.retired_versions(spark, warehouse)
                               for name in (*STATIC_TABLES, "trip_ends")])
    return views, spark.read.parquet(path)


def _in_place(spark: SparkSession, root: str, live: Live, report: DataFrame,
              kept: Live) -> DataFrame:
    """Bring the stored tables to ``kept``; returns the report of them as they were."""
    path = shared_dir(spark, "removed")
    report.write.parquet(path)
    sinks.keep_rows(root, live, kept)
    return spark.read.parquet(path)


def clean_realtime(spark: SparkSession, root: str, as_of: AsOf,
                   retention_days: int = 7) -> DataFrame:
    """Remove old trip updates, expired alerts and old messages with all that hangs on them from
    the tables below ``root``; returns the report. Ingest may go on meanwhile."""
    live = sinks.read_batches(spark, root, REALTIME_TABLES)
    return _in_place(spark, root, live, cleanup_report(live, as_of, retention_days),
                     after_cleanup(live, as_of, retention_days))


def remove_source(spark: SparkSession, root: str, source_id: int,
                  names: Sequence[str] = SOURCE_TABLES) -> DataFrame:
    """Remove the rows of one source from ``names`` and what hangs on them; returns their number
    in each table named."""
    live = sinks.read_batches(spark, root, REALTIME_TABLES)
    left = {**live, **{n: without_source(live, n, source_id) for n in names}}
    report = rows_by_source(live).where(
        (F.col("source_id") == source_id) & F.col("data_type").isin(*names))
    return _in_place(spark, root, live, report, cascade(left, left["feed_messages"]))


def purge_realtime(spark: SparkSession, root: str) -> DataFrame:
    """Empty the realtime tables below ``root``; returns what each held."""
    live = sinks.read_batches(spark, root, REALTIME_TABLES)
    return _in_place(spark, root, live, purge_report(live),
                     {name: df.where(F.lit(False)) for name, df in live.items()})
