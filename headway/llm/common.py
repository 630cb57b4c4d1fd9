"""Helpers shared by the operators: words, written cuts of the lineage, distributed ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.session import shared_dir

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array, empty for a missing text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def word_count(text: Column) -> Column:
    """Number of words, 0 for a missing text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def beside(df: DataFrame, *wanted: str) -> list[str]:
    """Names for columns of our own: the wanted ones, longer where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    What follows starts from files every executor can reach: a lost executor costs no more than
    its running tasks, and nothing in front is computed twice.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: list[Column], name: str, purpose: str) -> DataFrame:
    """``df`` with its 0-based position in ``order`` as long column ``name``.

    The rows are sorted by ranges over all tasks and written; only the number of rows of each
    range goes through the driver (one row per task, never per key). ``df`` should be cheap to
    read, as the ranges are found by a pass over it. Equal rows get positions in any order.
    """
    spark = df.sparkSession
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = written(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), purpose)
    counts = held.groupBy(F.shiftright("_at", 33).alias("_part")).count().collect()
    starts, total = [], 0
    for part, n in sorted((r["_part"], r["count"]) for r in counts):
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (held.withColumn("_part", F.shiftright("_at", 33))
            .join(F.broadcast(offsets), "_part", "left")  # one row per task
            .withColumn(name, F.col("_start") + inside)
            .drop("_at", "_part", "_start"))
