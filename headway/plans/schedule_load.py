"""Loading a schedule drop: files to typed, checked, versioned tables."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from headway.functions.clocks import AsOf
from headway.functions.texts import blank_to_null
from headway.operators import quality
from headway.operators.services import upcoming_services
from headway.operators.static_rows import TYPED
from headway.operators.stops import last_sequences, stop_routes
from headway.operators.versions import activate_version, create_version, has_newer_version
from headway.schemas import STATIC_TABLES
from headway.sources import sinks
from headway.sources.gtfs_files import listed_sources, scan_gtfs_file


def typed_tables(spark: SparkSession, root: str, version_id: int) -> dict[str, DataFrame]:
    """All schedule tables below ``root`` as typed rows of one version."""
    found = listed_sources(spark, root)
    return {name: TYPED[name](scan_gtfs_file(spark, root, name, sources=found[name]), version_id)
            for name in STATIC_TABLES}


def quality_report(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"pk_duplicates": quality.pk_duplicates(tables),
            "fk_orphans": quality.fk_orphans(tables),
            "check_violations": quality.check_violations(tables),
            "not_null_and_length": quality.not_null_and_length(tables)}


def newest_snapshot(spark: SparkSession, warehouse: str) -> int:
    saved = spark.read.parquet(f"{warehouse.rstrip('/')}/versions")
    return saved.agg(F.max("snapshot")).first()[0]


# A timetable without rows in these is no timetable.
REQUIRED = ["agency", "stops", "routes", "trips", "stop_times"]
# References that may be left blank: their columns are part of a key, so "no trip" is empty text.
MAY_BE_BLANK = {"transfers": ["from_trip_id", "to_trip_id"]}


def problems(tables: dict[str, DataFrame], parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """``table_name, rule, violations`` of every broken rule; no rows where a version may go live.

    Checked are keys, references (also to ``parents``: sources, versions), value ranges, missing
    and overlong values, and that no required table is empty. Trips whose service or shape is
    listed nowhere are allowed (``quality.unlisted_references`` reports them).
    """
    report = quality_report(tables)
    referring = dict(tables)
    for name in MAY_BE_BLANK.keys() & tables.keys():
        for column in MAY_BE_BLANK[name]:
            referring[name] = referring[name].withColumn(column, blank_to_null(F.col(column)))
    keys = (report["pk_duplicates"].groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("violations")).withColumn("rule", F.lit("repeated key")))
    references = quality.fk_orphans({**referring, **(parents or {})}).select(
        F.col("child").alias("table_name"), F.concat("column_name", F.lit(" not in "), "parent").alias("rule"),
        F.col("orphan_rows").alias("violations"))
    empty = [df.limit(1).agg((1 - F.count(F.lit(1))).alias("violations"))
             .withColumn("table_name", F.lit(name)).withColumn("rule", F.lit("no rows"))
             for name, df in tables.items() if name in REQUIRED]
    found = reduce(DataFrame.unionByName, [
        keys, references, report["check_violations"], report["not_null_and_length"], *empty])
    return found.where("violations > 0").select("table_name", "rule", "violations")


class Load(NamedTuple):
    """What became of a drop; ``version_id`` is NULL where it was not newer and not loaded."""

    version_id: int | None
    activated: bool
    broken: list[Row]


def load_schedule(spark: SparkSession, drop: str, warehouse: str, metadata: DataFrame,
                  as_of: AsOf, transport_sources: DataFrame | None = None) -> Load:
    """Load the files below ``drop`` as a new version and, if it keeps all rules, make it active.

    A drop that is not newer than the active version is not loaded. Otherwise tables are written,
    the rules are checked on what was written, and the versions table comes last: a failed load
    or a broken rule leaves the old version active and the new one inactive. The broken rules
    come back as one row each, at most as many as there are rules.
    """
    versions = sinks.load_versions(spark, warehouse)
    if not has_newer_version(metadata, versions).where("is_newer").head(1):
        return Load(None, False, [])
    created = create_version(versions, metadata, as_of)
    version_id = created.agg(F.max("version_id")).first()[0]
    snapshot = newest_snapshot(spark, warehouse)
    sinks.save_versions(created, warehouse, snapshot + 1)
    typed = typed_tables(spark, drop, version_id)
    sinks.write_version(typed, warehouse)
    # Where each trip ends is settled once, from the rows just written.
    written = {name: spark.read.schema(df.schema).parquet(f"{warehouse.rstrip('/')}/{name}")
               .where(F.col("version_id") == version_id) for name, df in typed.items()}
    sinks.write_version({"trip_ends": last_sequences(written["stop_times"])}, warehouse)
    listed = sinks.load_versions(spark, warehouse)
    parents = {"versions": listed}
    if transport_sources is not None:
        parents["transport_sources"] = transport_sources
    broken = problems(written, parents).collect()
    if not broken:
        sinks.save_versions(activate_version(listed, version_id), warehouse, snapshot + 2)
    return Load(version_id, not broken, broken)


def saved_views(spark: SparkSession, warehouse: str, as_of: AsOf) -> DataFrame:
    """Refresh the stop and service views from the stored active version."""
    names = ["stop_times", "trips", "routes", "agency", "calendar", "calendar_dates"]
    tables = sinks.read_version_tables(spark, warehouse, names)
    tables["versions"] = sinks.load_versions(spark, warehouse)
    views = {"stop_routes": lambda: stop_routes(tables),
             "active_services": lambda: upcoming_services(tables, as_of)}
    return sinks.refresh_views(spark, f"{warehouse.rstrip('/')}/views", views, as_of)
