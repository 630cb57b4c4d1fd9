"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the longest permitted length are cut into pieces of that length and a rest;
pieces are then packed, the largest first, each into the open sequence with the least room that
still takes it. Where none takes it, sequences of the length with the least cost per packed item
are opened. In the end every sequence is downsized to the shortest permitted length that holds
its contents.

Only how many pieces there are of each size matters to that: the plan is made on the counts by
size (at most as many rows as the longest length) and says, by runs, which pieces of a size go to
which sequences. Pieces find their place by their rank among the pieces of their size. So the
plan does not grow with the documents, and no task holds more than one run of rows.

Defined results: a document's size is its words plus one separator, so missing and empty texts are
one piece of size 1; repeated rows are documents of their own; equal sizes are ranked by id, then
text hash; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from headway.llm.common import ranked, word_count, written

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 32  # cost of a sequence besides its length, in words


def plan_bins(counts: dict[int, int], lengths: tuple[int, ...] = LENGTHS,
              overhead: float = OVERHEAD) -> tuple[list[tuple], list[tuple]]:
    """Runs ``(size, first rank, number, first bin, offset)`` and ``(first bin, number, used)``.

    Bins are handled in groups of equal contents; a run puts one piece into each bin of a group.
    """
    groups: dict[int, list[list[int]]] = {}  # room left -> [first bin, number, used]
    rooms: list[int] = []                    # sorted rooms that have groups
    runs, bins = [], 0

    def add(room: int, group: list[int]) -> None:
        if room not in groups:
            groups[room] = []
            bisect.insort(rooms, room)
        groups[room].append(group)

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                length, number = _open(size, left, lengths, overhead)
                add(length, [bins, number, 0])
                bins += number
                continue
            room = rooms[at]
            first, number, used = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[at]
            take = min(left, number)
            runs.append((size, rank, take, first, used))
            add(room - size, [first, take, used + size])
            if take < number:
                add(room, [first + take, number - take, used])
            left, rank = left - take, rank + take
    return runs, [tuple(g) for room in groups.values() for g in room]


def _open(size: int, left: int, lengths: tuple[int, ...], overhead: float) -> tuple[int, int]:
    """The length that costs least per piece of this size, and how many such bins to open.

    A bin's cost is its length and an overhead; the room that pieces of this size leave is
    credited by half, as smaller pieces are still to come.
    """
    best = None
    for length in lengths:
        fits = min(length // size, left)
        if not fits:
            continue
        waste = length - fits * size
        cost = (length + overhead - waste / 2) / fits
        if best is None or cost < best[0]:
            best = (cost, length, fits)
    _, length, fits = best
    return length, max(1, left // fits)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text",
         lengths: tuple[int, ...] = LENGTHS, overhead: float = OVERHEAD) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, size, bin, position, used, length``.

    ``start`` is the piece's first word in its document, ``position`` its first in the sequence,
    ``used`` and ``length`` the sequence's contents and final length.
    """
    lengths = tuple(sorted(lengths))
    longest = lengths[-1]
    sized = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                        F.xxhash64(F.col(f"`{text}`").cast("string")).alias("mark"),
                        (word_count(F.col(f"`{text}`").cast("string")) + 1).alias("total"))
    sized = written(sized, "pack-sizes")
    last = F.floor((F.col("total") - 1) / longest).cast("int")
    pieces = (sized.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
              .withColumn("start", F.col("piece").cast("long") * longest)
              .withColumn("size", F.least(F.col("total") - F.col("start"), F.lit(longest)).cast("int")))
    rank = ranked(pieces.select("size", "doc_id", "mark", "piece", "start"),
                  [F.col(c) for c in ("size", "doc_id", "mark", "piece")], "_rank", "pack-rank")
    # At most one row per size up to the longest length, whatever the documents.
    counts = {r["size"]: r["count"] for r in pieces.groupBy("size").count().collect()}
    before, total = {}, 0
    for size in sorted(counts):
        before[size] = total
        total += counts[size]
    runs, held = plan_bins(counts, lengths, overhead)
    return _placed(rank, runs, held, before, lengths)


def _placed(rank: DataFrame, runs: list[tuple], held: list[tuple], before: dict[int, int],
            lengths: tuple[int, ...]) -> DataFrame:
    spark = rank.sparkSession
    plan = pd.DataFrame(runs, columns=["size", "rank", "number", "bin", "position"], dtype="int64")
    # The ranks run on over all sizes, so that one sorted array finds the run of any piece.
    plan["first"] = plan["rank"] + plan["size"].map(before)
    plan = plan.sort_values("first")
    bins = pd.DataFrame(held, columns=["bin", "number", "used"], dtype="int64").sort_values("bin")
    tables = {name: spark.sparkContext.broadcast(frame.to_numpy()) for name, frame in (
        ("runs", plan[["first", "bin", "position"]]), ("bins", bins[["bin", "used"]]))}
    steps = np.array(lengths)

    def place(batches):
        runs, bins = tables["runs"].value, tables["bins"].value
        for pdf in batches:
            at = pdf["_rank"].to_numpy()
            run = runs[np.searchsorted(runs[:, 0], at, "right") - 1]
            where = run[:, 1] + at - run[:, 0]
            used = bins[np.searchsorted(bins[:, 0], where, "right") - 1, 1]
            yield pdf[["doc_id", "piece", "start", "size"]].assign(
                bin=where, position=run[:, 2], used=used,
                length=steps[np.searchsorted(steps, used)])

    return rank.mapInPandas(place, "doc_id long, piece int, start long, size int, bin long, "
                                   "position long, used long, length int")
