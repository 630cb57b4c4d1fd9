"""Schedule files: ``<root>/<source id>/google_transit/<table>.txt``.

Each ``<table>.txt`` may be one file or a folder of part files with the same header.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from headway.schemas import RAW_COLUMNS
from headway.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

# Fixed value: where a source's file must lie below the root.
LAYOUT = r"(?:^|/)([0-9]+)/google_transit/([a-z_]+)\.txt(?:/[^/]*)?$"


def source_from_path(path: Column) -> Column:
    """Source id in a file path, NULL where the path is not in the layout."""
    return F.nullif(F.regexp_extract(path, LAYOUT, 1), F.lit("")).try_cast("int")


def table_from_path(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, LAYOUT, 2), F.lit(""))


def scan_paths(spark: SparkSession, root: str) -> DataFrame:
    """(source_id, table_name) of every schedule file below ``root``.

    Only the file listing is read; folders that do not fit the layout are left out.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(root).select("path"))
    return (listing.select(source_from_path(F.col("path")).alias("source_id"),
                           table_from_path(F.col("path")).alias("table_name"))
            .where(F.col("source_id").isNotNull() & F.col("table_name").isin(list(RAW_COLUMNS)))
            .distinct())


CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "mode": "PERMISSIVE"}
# A quoted cell from its opening to its closing quote; the opening of one that the line does not
# close; what a line that begins inside a cell holds of it, with the closing quote.
WHOLE_CELL = r'(?:^|,)\s*+"[^"]*+(?:""[^"]*+)*+"\s*+(?=,|$)'
OPENED_CELL = r'(?:^|,)\s*+"'
REST_OF_CELL = r'^(?:[^"]++|""|"(?!\s*+(?:,|$)))*+"\s*+(?=,|$)'


def _opens(line: Column) -> Column:
    """Whether a line that begins outside a quoted cell ends inside one."""
    return F.regexp_replace(line, WHOLE_CELL, ",").rlike(OPENED_CELL)


def _stays_open(line: Column) -> Column:
    """Whether a line that begins inside a quoted cell ends inside one."""
    return ~line.rlike(REST_OF_CELL) | _opens(F.regexp_replace(line, REST_OF_CELL, ""))


def _spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether some cell goes on in a further line; the scan stops at the first that does."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return not lines.where(F.contains("value", F.lit('"')) & _opens(F.col("value"))).isEmpty()


def _followed(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """``rows`` with ``before0, after0, before1, after1``: the state (0 outside a quoted cell, 1
    inside) in front of and behind each row if the first of its group begins in 0, and in 1.

    A row maps the state it begins in to the one it ends in: ``outer`` from outside, ``inner`` from
    inside. Where both agree the state is known whatever came before; else it is kept or turned.
    """
    along = W.partitionBy(*by).orderBy(order)
    so_far = along.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("turns", F.sum(((F.col("outer") == 1) & (F.col("inner") == 0)).cast("int")).over(so_far))
    rows = rows.withColumn("known", F.last(
        F.when(F.col("outer") == F.col("inner"), F.col("outer") + F.col("turns")), True).over(so_far))
    for start in (0, 1):
        rows = rows.withColumn(f"after{start}", F.pmod(F.coalesce("known", F.lit(start)) + F.col("turns"), F.lit(2)))
    for start in (0, 1):
        rows = rows.withColumn(f"before{start}", F.lag(f"after{start}", 1, start).over(along))
    return rows.drop("turns", "known", "outer", "inner")


# What a line makes of the state it begins in, as one number.
KEEPS, CLOSED, OPEN, TURNS = range(4)
LINES = "file bigint, split bigint, value string, makes int, blank boolean"
ENDS = "file bigint, split bigint, outer int, inner int, all0 bigint, all1 bigint, head string, tail0 string, tail1 string"


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """``LINES``: the lines of all files as their splits hold them, with the hash of the file's path."""
    text = spark.read.option("lineSep", "\n").text(path)
    quoted = F.contains("value", F.lit('"'))
    lines = text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.when(F.endswith("value", F.lit("\r")), F.regexp_replace("value", r"\r$", ""))
        .otherwise(F.col("value")).alias("value"))
    opens, stays = _opens(F.col("value")), _stays_open(F.col("value"))
    makes = (F.when(~quoted, KEEPS).when(opens, F.when(stays, OPEN).otherwise(TURNS))
             .otherwise(F.when(stays, KEEPS).otherwise(CLOSED)))
    return lines.select("*", makes.alias("makes"), (F.length(F.btrim("value")) == 0).alias("blank"))


def _after(makes: np.ndarray, state: int) -> np.ndarray:
    """The state behind each line of a stretch that begins in ``state``."""
    place = np.arange(len(makes))
    known = np.maximum.accumulate(np.where((makes == CLOSED) | (makes == OPEN), place, -1))
    turns = np.cumsum(makes == TURNS)
    since = np.where(known >= 0, turns - turns[known], turns)
    return (np.where(known >= 0, makes[known] == OPEN, state) + since) % 2


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The lines of each batch, split by split; a split may go on in the next batch."""
    for batch in batches:
        file, split = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("file", "split"))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:]):
            if end > start:
                yield (int(file[start]), int(split[start])), batch.slice(start, end - start)


def _walked(stretch: pa.RecordBatch, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State before and behind each line, and whether a record begins there; blank lines outside of
    cells are none."""
    makes = stretch.column("makes").to_numpy(zero_copy_only=False)
    blank = stretch.column("blank").to_numpy(zero_copy_only=False).astype(bool)
    after = _after(makes, state)
    before = np.concatenate([[state], after[:-1]])
    return before, after, (before == 0) & ~blank


def _split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ENDS``, one row per split: the state it ends in and its records if it begins outside a quoted
    cell (0) and inside (1); the lines that end a record begun in front of it, if it begins inside;
    the lines of a record that it begins and does not end."""
    def row() -> pa.RecordBatch:
        text = lambda lines: "\n".join(lines) if lines else None
        values = [*key, *states, *begun, text(head), *[text(t) if s else None for t, s in zip(tails, states)]]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, 2 * [pa.int64()] + 2 * [pa.int32()] + 2 * [pa.int64()] + 3 * [pa.string()])],
            ["file", "split", "outer", "inner", "all0", "all1", "head", "tail0", "tail1"])

    key = None
    for found, stretch in _stretches(batches):
        if found != key:
            if key is not None:
                yield row()
            key, states, begun, head, closed, tails = found, [0, 1], [0, 0], [], False, [None, None]
        lines = stretch.column("value")
        for start in (0, 1):
            before, after, begins = _walked(stretch, states[start])
            if start == 1 and not closed:
                ends = np.flatnonzero(after == 0)
                closed = len(ends) > 0
                head += lines.slice(0, int(ends[0]) + 1 if closed else None).to_pylist()
            opened = np.flatnonzero(before == 0)
            if after[-1] == 0:
                tails[start] = None
            elif len(opened):
                tails[start] = lines.slice(int(opened[-1])).to_pylist()
            elif tails[start] is not None:
                tails[start] += lines.to_pylist()
            begun[start] += int(begins.sum())
            states[start] = int(after[-1])
    if key is not None:
        yield row()


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``record``: those that begin and end in one split, without the first of a file."""
    key = None
    for found, stretch in _stretches(batches):
        if found != key:  # ``lines``: of a record that this split began; None inside one from before
            key, state, begun = found, stretch.column("state")[0].as_py(), stretch.column("first")[0].as_py()
            lines, header = None, False
        before, after, begins = _walked(stretch, state)
        alone = begins & (after == 0)
        first = int(np.argmax(begins)) if begun == 0 and begins.any() else -1
        if first >= 0:
            alone[first] = False
        values = stretch.column("value")
        yield pa.RecordBatch.from_arrays([values.filter(pa.array(alone)).cast(pa.string())], ["record"])
        spanning = np.flatnonzero((before == 1) | (after == 1))
        joined = []
        for i, value in zip(spanning.tolist(), values.take(pa.array(spanning)).to_pylist()):
            if before[i] == 0:
                lines, header = [value], i == first
            elif lines is not None:
                lines.append(value)
            if after[i] == 0:
                if lines is not None and not header:
                    joined.append("\n".join(lines))
                lines = None
        if joined:
            yield pa.RecordBatch.from_arrays([pa.array(joined, pa.string())], ["record"])
        state, begun = int(after[-1]), begun + int(begins.sum())


def _records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the records of CSV files without their headers, also those whose quoted cells span
    lines.

    Lines stay in their splits. A first pass finds what each split makes of either state, how many
    records it begins and the lines of records that its ends cut, one row per split, stored in the
    shared folder. From these follow the state and the record number every split begins with. The
    second pass, with these, puts together the records inside a split; cut ones meet by their number.
    """
    lines, stored = _split_lines(spark, path), shared_dir(spark, "splits")
    lines.mapInArrow(_split_ends, ENDS).write.parquet(stored)
    ends = spark.read.schema(ENDS).parquet(stored)
    splits = _followed(ends, ["file"], "split").withColumn(
        "all", F.when(F.col("before0") == 0, F.col("all0")).otherwise(F.col("all1")))
    in_front = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.col("before0").alias("state"), "all", "head", "tail0", "tail1",
                           F.coalesce(F.sum("all").over(in_front), F.lit(0)).alias("first"))
    inside = F.col("state") == 1
    pieces = splits.select("file", "split", F.inline(F.array(
        F.struct(F.col("first").alias("number"), F.when(inside, F.col("head")).alias("text")),
        F.struct((F.col("first") + F.col("all")).alias("number"),
                 F.when(inside, F.col("tail1")).otherwise(F.col("tail0")).alias("text")))))
    parts = F.sort_array(F.collect_list(F.struct("split", "text")))
    cut = (pieces.where(F.col("text").isNotNull() & (F.col("number") > 1))  # 1 is the header
           .groupBy("file", "number").agg(parts.alias("parts"))
           .select(F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("record")))
    unknown = F.raise_error(F.lit("files or the size of splits have changed since the files were looked through"))
    told = lines.join(F.broadcast(splits.select("file", "split", "state", "first")), ["file", "split"], "left").select(
        *lines.columns, F.coalesce("state", unknown.cast("int")).cast("int").alias("state"), "first")
    return told.mapInArrow(_whole_records, "record string").union(cut)


def _read_source(spark: SparkSession, path: str, columns: list[str],
                 multiline: bool | None) -> DataFrame:
    """One source's file, columns taken by header name; absent columns are NULL."""
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=bool(multiline), **CSV)
    named = {}
    for position, field in enumerate(raw.columns):
        named[field.removeprefix("\ufeff").strip()] = position
    cells = [f"c{i}" for i in range(len(raw.columns))]
    if multiline is None and _spans_lines(spark, path):
        schema = ", ".join(f"{c} string" for c in cells)
        by_position = _records(spark, path).select(F.from_csv("record", schema, CSV).alias("r")).select("r.*")
    else:
        by_position = raw.toDF(*cells)
    return by_position.select(*[
        (F.col(f"c{named[c]}") if c in named else F.lit(None).cast("string")).alias(c)
        for c in columns])


def listed_sources(spark: SparkSession, root: str) -> dict[str, list[int]]:
    """Sources that have each table: the file listing, which the driver needs to name its reads."""
    found: dict[str, list[int]] = {name: [] for name in RAW_COLUMNS}
    for row in scan_paths(spark, root).collect():
        found[row.table_name].append(row.source_id)
    return {name: sorted(sources) for name, sources in found.items()}


def scan_gtfs_file(spark: SparkSession, root: str, name: str, *, sources: list[int] | None = None,
                   multiline: bool | None = None) -> DataFrame:
    """One schedule table of all sources, every cell as text, tagged with its source.

    A source without this file adds no rows. ``sources`` saves the listing where it is known.
    Records may span lines, and files are still read by split. Whether any does is looked up first,
    as lines then have to be looked through twice; ``multiline=False`` says that none does, ``True`` reads each
    file as a whole, in one task.
    """
    columns = RAW_COLUMNS[name]
    if sources is None:
        sources = listed_sources(spark, root)[name]
    parts = [
        _read_source(spark, f"{root.rstrip('/')}/{s}/google_transit/{name}.txt", columns, multiline)
        .withColumn("source_id", F.lit(s))
        for s in sources]
    if not parts:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                              + [T.StructField("source_id", T.IntegerType())])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def write_gtfs_files(table: DataFrame, root: str, name: str, sources: list[int]) -> None:
    """Write a text-celled table in the scanned layout (used to hand data on as files)."""
    for source in sources:
        (table.where(F.col("source_id") == source).select(*RAW_COLUMNS[name])
         .write.mode("overwrite").option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("emptyValue", "").csv(f"{root.rstrip('/')}/{source}/google_transit/{name}.txt"))
