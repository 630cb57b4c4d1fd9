"""Registration of queries beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalog.derived import Tables, with_ctes

Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Tables of the check engine that several queries' SQL refers to.
SHARED_SQL: dict[str, str] = {}

# Fixed clocks, UTC, with the local time each stands for in the service zone.
MORNING = "2024-01-14 21:00:00"   # Monday 2024-01-15 08:00
NIGHT = "2024-01-14 13:30:00"     # Monday 2024-01-15 00:30
RETENTION = "2024-01-22 00:00:00"  # seven days after the cutoff


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def plain(df: DataFrame) -> DataFrame:
    """Output columns in types both engines print alike."""
    def column(f: T.StructField):
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.DayTimeIntervalType):
            c = c.cast("interval second").cast("bigint")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",", "-")
        elif isinstance(t, (T.ShortType, T.ByteType)):
            c = c.cast("int")
        return c.alias(f.name)
    return df.select(*[column(f) for f in df.schema])


def ts(expression: str) -> str:
    """The check engine's text of a timestamp, as ``plain`` writes it."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def iso(expression: str) -> str:
    """The check engine's ISO text of a UTC timestamp, as payloads carry it."""
    text = f"strftime({expression}, '%Y-%m-%dT%H:%M:%S.%f')"
    return f"regexp_replace({text}, '\\.?0+$', '') || '+00:00'"


def runner(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(fn(Tables.of(spark, sf_dir)))
    return run


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(fn) for name, fn in QUERIES.items()}


def check_sql() -> dict[str, str]:
    return {name: with_ctes(text, SHARED_SQL) for name, text in SQL.items()}
