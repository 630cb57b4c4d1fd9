"""Periodic runs of words: stretches that repeat themselves, and texts without their repeats.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are the
same) of at least ``LEAST`` words and three periods that no neighbouring word extends.

Every text is taken alone, in the task that reads it: nothing is shuffled. Its suffixes are sorted
by doubling, and the tree of their LCP intervals is walked bottom-up. An interval holds the
places where its ``depth`` common words start, as lists by the word to the left. Two places from
different children with different left words are a maximal pair: neither side can be extended.
Where their distance ``p`` is at most half the depth, the words from the first place to the end
of the second are a run of ``depth + p`` words, so pairs whose distance and depth meet the limits
are all there is to look for, and intervals of less than ``LEAST - LEAST // 3`` words hold none of
them. A stretch is met with its smallest period and multiples of it; the smallest counts.

Places at most half the depth apart repeat the interval's words with their smallest period, so
all but the first of such a chain have the same word to the left. A place therefore pairs with
all of one list in front of it or none, and behind it with the farthest place or none: each is
found by a binary search, and the smaller child is entered into the larger.

Defined results: missing and empty texts and those of white space have no words, no runs and an
empty collapsed text; words are compared as they are, by bytes; repeated rows and ids, missing ids
and ties are rows of their own; a long text needs memory in proportion to its words times the
doublings that its longest repeat takes; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.common import words

LEAST = 24               # words of a run
TIMES = 3                # periods of a run
SHALLOW = LEAST - LEAST // TIMES   # a run of 24 words and 3 periods repeats 16 words
TOGETHER = 1 << 18       # words of the texts sorted at once (a longer text is sorted alone)
RUNS = "array<struct<start:long,length:long,period:long>>"


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers that no two texts share, each text closed by a number of its own, and
    where the texts start."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.empty(starts[-1], np.int64)
    for start, text in zip(starts.tolist(), texts):
        ids[start:start + len(text)] = np.fromiter(
            map({}.setdefault, text, count(start)), np.int64, len(text))
        ids[start + len(text)] = start + len(text)
    return ids, starts


def repeats_itself(ids: np.ndarray, depth: int = SHALLOW) -> np.ndarray:
    """Whether the ``depth`` words at each place stand anywhere else in their text."""
    kind, alive, size = ids, np.ones(len(ids), bool), 1
    while alive.any():
        step = min(size, depth - size)
        places = np.flatnonzero(alive[:len(ids) - step] & alive[step:])
        _, found, times = np.unique(kind[places] * (len(ids) + 1) + kind[places + step],
                                    return_inverse=True, return_counts=True)
        alive = np.zeros(len(ids), bool)
        alive[places] = times[found] > 1
        kind = np.zeros(len(ids), np.int64)
        kind[places] = found
        size += step
        if size == depth:
            break
    return alive


def suffix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... words, until all differ."""
    def ranked(order: np.ndarray, key: np.ndarray, base: np.ndarray) -> np.ndarray:
        place = np.arange(len(order))
        old = np.concatenate([[True], base[order][1:] != base[order][:-1]])
        new = old | np.concatenate([[True], key[order][1:] != key[order][:-1]])
        first = np.maximum.accumulate(np.where(old, place, 0))
        rank = np.empty(len(order), np.int64)
        rank[order] = base[order] + np.maximum.accumulate(np.where(new, place, 0)) - first
        return rank

    n = len(ids)
    levels = [ranked(np.argsort(ids, kind="stable"), ids, np.zeros(n, np.int64))]
    size = 1
    while True:
        rank = levels[-1]
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(tied):
            return levels
        after = rank[np.minimum(tied + size, n - 1)]
        key = rank[tied] * (n + 1) + after
        rank = rank.copy()
        rank[tied] = ranked(np.argsort(key, kind="stable"), key, rank[tied])
        levels.append(rank)
        size *= 2


def common_words(levels: list[np.ndarray], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Number of words that the suffixes at two places share."""
    shared = np.zeros(len(one), np.int64)
    for i in range(len(levels) - 1, -1, -1):
        same = levels[i][one + shared] == levels[i][other + shared]
        shared += same.astype(np.int64) << i
    return shared


class Interval:
    """Places where the common words of an LCP interval start: all, and by the word to the left."""

    __slots__ = ("places", "lists")

    def __init__(self, place: int, word: int):
        self.places, self.lists = [place], {word: [place]}

    def take(self, other: Interval, depth: int, left: list[int], out: list[tuple]) -> Interval:
        """One interval of both children; maximal pairs at most half the depth apart go to ``out``."""
        large, small = (self, other) if len(self.places) >= len(other.places) else (other, self)
        reach, places = depth // (TIMES - 1), large.places
        for x in small.places:
            word = left[x]
            at = bisect_left(places, x - reach)
            if at < len(places) and places[at] < x and left[places[at]] != word:
                out.append((places[at], x, depth))
            at = bisect_right(places, x)
            if at < len(places) and places[at] - x <= reach and left[places[at]] != word:
                behind = large.lists[left[places[at]]]
                for y in behind[bisect_right(behind, x):bisect_right(behind, x + reach)]:
                    out.append((x, y, depth))
        for held, new in ((places, small.places), *((large.lists.setdefault(w, []), found)
                                                    for w, found in small.lists.items())):
            if not held or held[-1] < new[0]:
                held.extend(new)
            else:
                for x in new:
                    insort(held, x)
        return large


def maximal_pairs(places: list[int], depths: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(first place, second place, common words) over the tree of LCP intervals, bottom-up.

    ``places`` are suffixes in their order, ``depths[i]`` the words that the i-th shares with the
    one in front (0 where a tree ends), with one 0 more at the end.
    """
    out: list[tuple] = []
    open_: list[tuple[Interval, int]] = []
    for i, place in enumerate(places):
        here, depth, ahead = Interval(place, left[place]), depths[i], depths[i + 1]
        while depth and depth >= ahead:
            before, further = open_.pop()
            here = before.take(here, depth, left, out)
            depth = further
        if ahead:
            open_.append((here, depth))
    return out


def find_runs(texts: list[list[bytes]], least: int = LEAST) -> dict[int, list[tuple[int, int, int]]]:
    """By text that has any: its runs as (start, length, period), by start, then period."""
    shallow = least - least // TIMES
    ids, starts = numbered(texts)
    places = np.flatnonzero(repeats_itself(ids, shallow))
    if not len(places):
        return {}
    which = np.unique(np.searchsorted(starts, places, "right") - 1)
    ids, starts = numbered([texts[i] for i in which])
    levels = suffix_ranks(ids)
    order = np.argsort(levels[-1], kind="stable")
    shared = np.concatenate([[0], common_words(levels, order[:-1], order[1:]), [0]])
    shared[shared < shallow] = 0
    keep = (shared[:-1] > 0) | (shared[1:] > 0)
    before = np.concatenate([[-1], ids[:-1]])
    before[starts[:-1]] = -1
    pairs = maximal_pairs(order[keep].tolist(), [*shared[:-1][keep].tolist(), 0], before.tolist())
    smallest: dict[tuple[int, int], int] = {}
    for first, second, depth in pairs:
        period = second - first
        if depth + period >= least:
            stretch = first, depth + period
            smallest[stretch] = min(period, smallest.get(stretch, period))
    out = defaultdict(list)
    for (first, length), period in smallest.items():
        at = int(np.searchsorted(starts, first, "right")) - 1
        out[int(which[at])].append((first - int(starts[at]), length, period))
    return {i: sorted(found, key=lambda r: (r[0], r[2])) for i, found in out.items()}


def collapsed(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        inside = np.zeros(len(text) + 1, np.int64)
        for start, length, period in runs:
            inside[start + period] += 1
            inside[start + length] -= 1
        text = [w for w, n in zip(text, np.cumsum(inside).tolist()) if not n]
    return b" ".join(text)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def solved(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = find_runs(texts)
        found = [[dict(zip(("start", "length", "period"), r)) for r in runs.get(i, ())]
                 for i in range(len(texts))]
        kept = [collapsed(t, runs.get(i, [])).decode() for i, t in enumerate(texts)]
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(map(len, texts), pa.int64()), pa.array(found, kind), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    for batch in batches:
        first, held, size = 0, [], 0
        for i, text in enumerate(batch.column("text")):
            held.append((text.as_py() or b"").split())  # at ASCII white space
            size += len(held[-1])
            if size >= TOGETHER or i + 1 == batch.num_rows:
                yield solved(batch.column("doc_id").slice(first, len(held)), held)
                first, held, size = i + 1, [], 0


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every document: its runs by start, then period, and
    its words without the repeats."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_batches, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of most periods, the first of equals; NULL without runs."""
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.reduce(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` where one of ten documents repeats some of its words up to its end."""
    number = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    held = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       words(F.col(f"`{text}`")).alias("parts"), number.alias("h"))
    n, g = F.size("parts").cast("long"), F.floor(F.col("h") / 10)
    start = (g % F.greatest(n, F.lit(1))).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    rest = (n - start).cast("int")
    again = F.flatten(F.array_repeat(F.slice("parts", start + 1, period), F.ceil(rest / period).cast("int")))
    planted = F.array_join(F.concat(F.slice("parts", F.lit(1), start), F.slice(again, F.lit(1), rest)), " ")
    return held.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), planted)
                       .otherwise(F.col("text")).alias("text"))
