"""Transport sources and their upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Ids and names of the transport sources.
TRANSPORT_SOURCES = [
    (1, "Regional Train"),
    (2, "Metropolitan Train"),
    (3, "Metropolitan Tram"),
    (4, "Metropolitan Bus"),
    (5, "Regional Coach"),
    (6, "Regional Bus"),
    (10, "Interstate"),
    (11, "SkyBus"),
]


def inline_rows(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Fixed rows as a literal table, whose size the optimizer knows."""
    values = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def transport_sources(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, ["source_id", "source_name"], TRANSPORT_SOURCES)


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``new`` rows replace ``old`` rows of the same key and add the others."""
    return new.unionByName(old.join(new, key, "left_anti"), allowMissingColumns=True)
