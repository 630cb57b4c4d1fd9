"""Imported versions: which one is active, what replaces it, what may go."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.clocks import AsOf, day_age, instant


def active_version(versions: DataFrame) -> DataFrame:
    """The active version row, or no row."""
    return versions.where("is_active").orderBy("version_id").limit(1)


def active_version_id(versions: DataFrame) -> Column:
    """The active version's id as a scalar subquery; NULL where none is active.

    As a filter on a table partitioned by ``version_id`` it prunes partitions.
    """
    return versions.where("is_active").agg(F.min("version_id")).scalar()


def in_scope(table: DataFrame, versions: DataFrame, source_id: int | None = None,
             version_id: int | None = None) -> DataFrame:
    """Rows of one version (the active one by default) and optionally one source."""
    wanted = F.lit(version_id) if version_id is not None else active_version_id(versions)
    rows = table.where(F.col("version_id") == wanted)
    return rows if source_id is None else rows.where(F.col("source_id") == source_id)


def has_newer_version(candidates: DataFrame, versions: DataFrame) -> DataFrame:
    """``candidates(last_modified, ...)`` with whether each is newer than the active version."""
    current = versions.where("is_active").agg(F.max("updated_at")).scalar()
    return (candidates.withColumn("active_updated_at", current)
            .withColumn("is_newer", F.coalesce(F.col("last_modified") > F.col("active_updated_at"),
                                               F.col("active_updated_at").isNull())))


def new_version_row(metadata: DataFrame, version_id: Column, created_at: AsOf) -> DataFrame:
    """Inactive version rows for portal metadata ``(url, last_modified)``."""
    stamp = F.col("last_modified")
    zulu = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return metadata.select(
        version_id.cast("int").alias("version_id"),
        F.concat(F.lit("gtfs_"), F.date_format(stamp, "yyyy-MM-dd_HH:mm:ss")).alias("version_name"),
        instant(created_at).alias("created_at"),
        stamp.alias("updated_at"),
        F.lit(False).alias("is_active"),
        F.col("url").alias("source_url"),
        F.format_string("GTFS data imported from %s at %s", F.col("url"), zulu).alias("description"))


def create_version(versions: DataFrame, metadata: DataFrame, created_at: AsOf) -> DataFrame:
    """``versions`` with one more, inactive row for one accepted portal answer."""
    last = F.coalesce(versions.agg(F.max("version_id")).scalar(), F.lit(0))
    return versions.unionByName(new_version_row(metadata, last + 1, created_at),
                                allowMissingColumns=True)


def activate_version(versions: DataFrame, version_id: int) -> DataFrame:
    """``versions`` with exactly ``version_id`` active; an unknown id fails when run."""
    known = versions.where(F.col("version_id") == version_id).agg(F.count(F.lit(1))).scalar()
    checked = F.when(known > 0, F.col("version_id") == version_id).otherwise(
        F.raise_error(F.lit(f"version {version_id} not found")).cast("boolean"))
    return versions.withColumn("is_active", checked)


def versions_to_delete(versions: DataFrame, keep: int = 1) -> DataFrame:
    """Inactive versions beyond the ``keep`` newest.

    The newest are a top-k, which each task cuts to ``keep`` rows; skipping them by offset
    would bring all versions into one task.
    """
    inactive = versions.where("not is_active")
    newest = inactive.orderBy(F.desc("created_at"), F.desc("version_id")).limit(keep)
    return inactive.join(newest.select("version_id"), "version_id", "left_anti")


def _counts(tables: dict[str, DataFrame]) -> DataFrame:
    per_table = [df.groupBy("version_id").agg(F.count(F.lit(1)).alias("n"))
                 for df in tables.values()]
    return reduce(DataFrame.unionByName, per_table)


def delete_versions(versions: DataFrame, tables: dict[str, DataFrame],
                    keep: int = 1) -> DataFrame:
    """Report of what deleting old versions removes, with a closing summary row."""
    doomed = versions_to_delete(versions, keep).select("version_id", "version_name")
    # Counting first leaves a handful of rows per table; the join then costs nothing.
    counts = _counts(tables).groupBy("version_id").agg(F.sum("n").alias("n"))
    rows = (doomed.join(counts, "version_id", "left")
            .select("version_id", "version_name",
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("records_deleted"),
                    F.lit("SUCCESS").alias("cleanup_status")))
    # Nothing to delete, nothing to report: the summary needs at least one row.
    summary = (rows.agg(F.sum("records_deleted").alias("total"), F.count(F.lit(1)).alias("versions"))
               .where("versions > 0")
               .select(F.lit(None).cast("int").alias("version_id"),
                       F.lit("CLEANUP_SUMMARY").alias("version_name"),
                       F.col("total").alias("records_deleted"),
                       F.lit("COMPLETED").alias("cleanup_status")))
    return rows.unionByName(summary)


def without_versions(table: DataFrame, doomed: DataFrame) -> DataFrame:
    """Rows of ``table`` that stay once the ``doomed`` versions are gone."""
    return table.join(doomed.select("version_id"), "version_id", "left_anti")


def list_versions_with_counts(versions: DataFrame, tables: dict[str, DataFrame],
                              as_of: AsOf) -> DataFrame:
    """Versions, newest first, with row counts of their main tables and age in days."""
    listed = versions
    for name in ("stop_times", "trips", "stops"):
        counts = tables[name].groupBy("version_id").agg(F.count(F.lit(1)).alias(f"{name}_count"))
        listed = listed.join(counts, "version_id", "left")
    return (listed.select(
        "version_id", "version_name", "created_at", "is_active",
        *[F.coalesce(f"{n}_count", F.lit(0)).cast("bigint").alias(f"{n}_count")
          for n in ("stop_times", "trips", "stops")],
        day_age(as_of, F.col("created_at")).alias("age_days"))
        .orderBy(F.desc("created_at"), F.desc("version_id")))
