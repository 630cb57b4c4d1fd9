"""Removal of long repeated byte strings, by merged Burrows-Wheeler transforms.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else (another document or
the same one) is removed; matches never cross documents and are judged on the input.

1. Every window of LENGTH bytes names one anchor in it: the GRAM-byte string of the smallest hash.
   Equal windows name equal anchors at equal places, so only windows around an anchor that occurs
   more than once can be repeated. Anchors are 1 to 2 % of the bytes; their counts are one
   aggregation, and most end there.
2. An anchor's context is all that the windows naming it cover. A context that occurs more than
   once is repeated whole: copies of any number are settled by a count.
3. What is left are the edges of repeats: contexts that occur once around an anchor that occurs
   more often. They are dealt out by anchor; each task sorts blocks of them, merges the blocks'
   transforms by interleave refinement (``bwt``) and reads the repeated windows off the intervals
   that have not parted after LENGTH bytes. Windows are the same place only if they have the same
   anchor at the same distance, so a place never meets itself.
4. An anchor with more than ``HOT`` contexts (a passage in very many documents) is dealt out
   further, by what its windows have in common, and finally by the windows' own hashes, so that no
   task gets more than a share of it.

Defined results: missing and empty texts are 0 bytes, nothing removed; texts under LENGTH bytes
are kept whole; repeated rows repeat each other and are removed whole (from LENGTH bytes on); a
missing doc_id is an id like any other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.bwt import repeated_intervals
from headway.llm.common import written

LENGTH = 200
GRAM = 64
REACH = LENGTH - GRAM           # bytes on either side of an anchor that its windows can cover
WIDTH = LENGTH + REACH          # of a context
PIECE = 1 << 20                 # windows hashed at once
GROUP = 4096                    # contexts a task's transform aims at
HOT = 16384                     # contexts of one anchor that one task takes
PART = 8                        # window offsets that share a core
_INDEX = np.uint64((1 << 22) - 1)


class Rolling:
    """Hashes of any substring by differences of one running sum, modulo 2**64."""

    def __init__(self, seed: int, size: int):
        rng = np.random.default_rng(seed)
        self.byte = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 62, 1 << 63)) * 2 + 1
        self.up = _powers(base, size)
        self.down = _powers(pow(base, -1, 1 << 64), size)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums along the last axis, with a leading zero."""
        terms = self.byte[data]
        terms *= self.up[:data.shape[-1]]
        out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
        np.cumsum(terms, axis=-1, out=out[..., 1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.down[start])


def _powers(base: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    span, least = 1, keys
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


class Scanner:
    """Anchors of texts: (text, position, bytes of the context before it and from it on, hash of
    the anchor, hash of its context)."""

    def __init__(self):
        size = PIECE + LENGTH + 2 * WIDTH + 2
        self.gram, self.context = Rolling(11, size), Rolling(12, size)

    def scan(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """For texts of at least LENGTH bytes each, in pieces of at most PIECE windows."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(texts), np.uint8)
        for low in range(0, len(data), PIECE):
            high = min(low + PIECE, len(data) - LENGTH + 1)
            if high <= low:
                break
            a, b = max(0, low - WIDTH), min(len(data), high + LENGTH + WIDTH)
            sums = self.gram.sums(data[a:b])
            at = np.arange(low - a, high - a + REACH)
            hashes = self.gram.between(sums, at, at + GRAM)
            # The smallest hash wins, of equal ones the leftmost.
            keys = (hashes & ~_INDEX) | np.arange(len(at), dtype=np.uint64)
            chosen = (sliding_least(keys, REACH + 1) & _INDEX).astype(np.int64)
            inside = np.ones(high - low, bool)
            for end in ends[np.searchsorted(ends, low, "right"):]:
                if end - LENGTH + 1 >= high:
                    break
                inside[max(0, end - LENGTH + 1 - low):max(0, end - low)] = False
            window = np.flatnonzero(inside)
            chosen = chosen[window]
            if not len(chosen):
                continue
            # Neighbouring windows that name one anchor are one row: its context there.
            begin = np.flatnonzero(np.diff(chosen, prepend=-1))
            where, final = chosen[begin] + low, np.append(begin[1:], len(chosen)) - 1
            start, stop = window[begin] + low, window[final] + low + LENGTH
            text = np.searchsorted(ends, where, "right")
            around = self.context.sums(data[a:b])
            context = self.context.between(around, start - a, stop - a)
            left, right = where - start, stop - where
            context = mixed(context ^ (left * 512 + right).astype(np.uint64))
            yield (text, where - (ends[text] - lengths[text]), left, right,
                   hashes[chosen[begin]].view(np.int64), context.view(np.int64))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        marks = batch.column("mark").to_numpy(zero_copy_only=False)
        texts, rows, size = [], [], 0
        for i, body in enumerate([*batch.column("body"), None]):
            if body is not None:
                body = body.as_py()
                texts.append(body)
                rows.append(i)
                size += len(body)
            if texts and (body is None or size >= 2 * PIECE):
                row = np.array(rows)
                for text, *found in scanner.scan(texts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (ids[row[text]], marks[row[text]], *found)],
                        names=["id", "mark", "pos", "left", "right", "gram", "ctx"])
                texts, rows, size = [], [], 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts asked for in each text."""
    names = ["gram", "id", "mark", "pos", "n", "left", "body"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for i, m, body, asked in zip(*(batch.column(c) for c in ("id", "mark", "body", "asked"))):
            body = body.as_py()
            for a in asked.as_py():
                row = (a["gram"], i.as_py(), m.as_py(), a["pos"], a["n"], a["left"],
                       body[a["pos"] - a["left"]:a["pos"] + a["right"]])
                for column, value in zip(out, row):
                    column.append(value)
        kinds = [pa.int64()] * 4 + [pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=names)


def _aligned(bodies: list[bytes], left: np.ndarray) -> np.ndarray:
    """Contexts as rows of bytes with their anchors in one column."""
    grid = np.zeros((len(bodies), WIDTH), np.uint8)
    for i, (body, at) in enumerate(zip(bodies, left)):
        grid[i, REACH - at:REACH - at + len(body)] = np.frombuffer(body, np.uint8)
    return grid


def _parts(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first column, end column, rows) of what PART neighbouring windows have in common."""
    for least in range(0, REACH + 1, PART):
        most = min(least + PART - 1, REACH)
        # Some window that begins least..most bytes before the anchor lies in the context.
        yield (REACH - least, REACH - most + LENGTH,
               np.maximum(least, LENGTH - right) <= np.minimum(most, left))


def _active(gram: np.ndarray, bodies: list[bytes], left: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """Where in each context windows begin and end whose common part another context shares;
    an end of 0 where there are none."""
    right = np.array([len(b) for b in bodies]) - left
    first, last = np.full(len(bodies), WIDTH), np.zeros(len(bodies), np.int64)
    rolling = Rolling(13, WIDTH)
    sums = rolling.sums(_aligned(bodies, left))
    for start, end, fits in _parts(left, right):
        rows = np.flatnonzero(fits)
        core = mixed(sums[rows, end] - sums[rows, start]) ^ gram[rows].view(np.uint64)
        _, inverse, counts = np.unique(core, return_inverse=True, return_counts=True)
        rows = rows[counts[inverse] > 1]
        first[rows] = np.minimum(first[rows], end - LENGTH)
        last[rows] = np.maximum(last[rows], start + LENGTH)
    shift = REACH - left  # column of a context's first byte
    return np.maximum(first - shift, 0), np.minimum(last - shift, left + right) * (last > 0)


def _windows(gram: np.ndarray, bodies: list[bytes], left: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset) of the windows that begin like another context's, at the same distance
    from the same anchor."""
    string, offset, interval = repeated_intervals(bodies, LENGTH)
    ahead = left[string] - offset
    fits = (ahead >= 0) & (ahead <= REACH)
    string, offset, interval, ahead = (x[fits] for x in (string, offset, interval, ahead))
    if not len(string):
        return string, offset
    _, anchor = np.unique(gram[string], return_inverse=True)
    key = (interval * (int(anchor.max()) + 1) + anchor) * (REACH + 1) + ahead
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    return string[again], offset[again]


def _windows_by_part(gram: np.ndarray, bodies: list[bytes], left: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray]:
    """The same for many contexts: by neighbouring windows, and among those that share a core."""
    right = np.array([len(b) for b in bodies]) - left
    grid, rolling = _aligned(bodies, left), Rolling(13, WIDTH)
    sums, found = rolling.sums(grid), []
    for start, end, fits in _parts(left, right):
        rows = np.flatnonzero(fits)
        core = mixed(sums[rows, end] - sums[rows, start]) ^ gram[rows].view(np.uint64)
        _, inverse, counts = np.unique(core, return_inverse=True, return_counts=True)
        rows, inverse = rows[counts[inverse] > 1], inverse[counts[inverse] > 1]
        order = np.argsort(inverse, kind="stable")
        rows, inverse = rows[order], inverse[order]
        edges = np.append(np.flatnonzero(np.diff(inverse, prepend=-1)), len(rows))
        low = 0
        for i in range(1, len(edges)):
            if edges[i] - edges[low] < GROUP and i < len(edges) - 1:
                continue
            some = rows[edges[low]:edges[i]]
            low = i
            first = np.maximum(end - LENGTH, REACH - left[some])
            last = np.minimum(start + LENGTH, REACH + right[some])
            strings = [grid[r, a:b].tobytes() for r, a, b in zip(some, first, last)]
            string, offset = _windows(gram[some], strings, REACH - first)
            found.append((some[string], offset + first[string] - (REACH - left[some[string]])))
    string = np.concatenate([np.zeros(0, np.int64), *(f[0] for f in found)])
    offset = np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)])
    return string, offset


def _spans(pdf: pd.DataFrame, string: np.ndarray, offset: np.ndarray) -> pd.DataFrame:
    """Covered ranges of the texts, a row for each run of neighbouring windows."""
    single = (pdf["n"].to_numpy() == 1)[string]  # the others are repeated whole
    string, offset = string[single], offset[single]
    if not len(string):
        return pd.DataFrame({"id": [], "mark": [], "start": [], "stop": []}, dtype="int64")
    order = np.lexsort((offset, string))
    string, offset = string[order], offset[order]
    first = np.ones(len(string), bool)
    first[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(string)) - 1
    base = (pdf["pos"] - pdf["left"]).to_numpy()[string[begin]]
    return pd.DataFrame({"id": pdf["id"].to_numpy()[string[begin]],
                         "mark": pdf["mark"].to_numpy()[string[begin]],
                         "start": base + offset[begin], "stop": base + offset[end] + LENGTH})


def _judge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows among the contexts of some anchors."""
    gram, left = pdf["gram"].to_numpy(), pdf["left"].to_numpy()
    bodies = list(pdf["body"])
    first, last = _active(gram, bodies, left)
    bodies = [b[f:e] for b, f, e in zip(bodies, first, last)]
    pdf = pdf.assign(body=bodies, left=left - first)[last > 0]
    found = []
    # Whole anchors at a time, so that a transform stays within memory.
    for part in _batches(pdf.sort_values("gram", kind="stable").reset_index(drop=True)):
        string, offset = (_windows if len(part) <= 2 * GROUP else _windows_by_part)(
            part["gram"].to_numpy(), list(part["body"]), part["left"].to_numpy())
        found.append(_spans(part, string, offset))
    if not found:
        return pd.DataFrame({"id": [], "mark": [], "start": [], "stop": []}, dtype="int64")
    return pd.concat(found)


def _batches(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    gram = pdf["gram"].to_numpy()
    edges = np.append(np.flatnonzero(np.diff(gram, prepend=~gram[:1])), len(gram))
    low = 0
    for i in range(1, len(edges)):
        if edges[i] - edges[low] >= GROUP or i == len(edges) - 1:
            yield pdf.iloc[edges[low]:edges[i]].reset_index(drop=True)
            low = i


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per context and part: hashes of the common core and of each window, for hot anchors."""
    one, two = Rolling(14, WIDTH), Rolling(15, WIDTH)
    kinds = [pa.int64()] * 5 + [pa.int32()] + [pa.list_(pa.int64())] * 2
    names = ["core", "core2", "id", "mark", "base", "least", "w1", "w2"]
    for batch in batches:
        pdf = batch.to_pandas()
        for low in range(0, len(pdf), GROUP):
            rows = pdf.iloc[low:low + GROUP]
            left, bodies = rows["left"].to_numpy(), list(rows["body"])
            right = np.array([len(b) for b in bodies]) - left
            grid, out = _aligned(bodies, left), [[] for _ in names]
            sums = one.sums(grid), two.sums(grid)
            gram = rows["gram"].to_numpy().view(np.uint64)
            for start, end, fits in _parts(left, right):
                least, most = REACH - start, REACH - (end - LENGTH)
                rest = np.flatnonzero(fits)
                core = [mixed(s[rest, end] - s[rest, start] + (gram[rest] ^ np.uint64(least)))
                        .view(np.int64) for s in sums]
                for i, r in enumerate(rest):
                    # A window is known by its anchor and distance too, so it never meets itself.
                    ahead = np.arange(max(least, LENGTH - right[r]), min(most, left[r]) + 1)
                    begin, tag = REACH - ahead, gram[r] ^ ahead.astype(np.uint64)
                    hashes = [mixed((s[r, begin + LENGTH] - s[r, begin]) * k.down[begin] + tag)
                              for s, k in zip(sums, (one, two))]
                    cores = [int(c[i]) for c in core]
                    values = (*cores, int(rows["id"].iloc[r]), int(rows["mark"].iloc[r]),
                              int(rows["pos"].iloc[r]), int(ahead[0]),
                              hashes[0].view(np.int64).tolist(), hashes[1].view(np.int64).tolist())
                    for column, value in zip(out, values):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)],
                                             names=names)


def _hot_spans(contexts: DataFrame) -> DataFrame:
    """Repeated windows of anchors too frequent for one task, by counts of hashes alone."""
    parts = written(contexts.mapInArrow(
        _cores, "core long, core2 long, id long, mark long, base long, least int, "
                "w1 array<long>, w2 array<long>"), "repeat-parts")
    twice = parts.groupBy("core", "core2").count().where("count > 1").drop("count")
    windows = (parts.join(twice, ["core", "core2"])
               .select("id", "mark", "base", "least", F.posexplode(F.arrays_zip("w1", "w2")))
               .select("id", "mark", (F.col("base") - F.col("least") - F.col("pos")).alias("start"),
                       "col.w1", "col.w2"))
    again = windows.groupBy("w1", "w2").count().where("count > 1").drop("count")
    return windows.join(again, ["w1", "w2"]).select(
        "id", "mark", "start", (F.col("start") + LENGTH).alias("stop"))


def covered(spans: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of ``spans`` (start, stop) within a text of ``size`` bytes."""
    runs: list[list[int]] = []
    for start, stop in sorted(map(tuple, spans)):
        start, stop = max(0, start), min(size, stop)
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        elif start < stop:
            runs.append([start, stop])
    return [(a, b) for a, b in runs]


def _keys(key: str, text: str) -> list[Column]:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return [F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(-1)).alias("id"),
            F.xxhash64(body).alias("mark"), body.cast("binary").alias("body")]


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT
                   ) -> DataFrame:
    """``id, mark, start, stop``: byte ranges, which may overlap and reach past the text."""
    rows = docs.select(*_keys(key, text)).where(F.octet_length("body") >= LENGTH)
    anchors = written(rows.mapInArrow(
        _anchors, "id long, mark long, pos long, left long, right long, gram long, ctx long"),
        "repeat-anchors")
    often = anchors.groupBy("gram").count().where("count > 1").select("gram")
    shared = written(anchors.join(often, "gram"), "repeat-shared")
    contexts = written(shared.groupBy("gram", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "mark", "pos", "left", "right")).alias("at")),
        "repeat-contexts")
    whole = (shared.join(contexts.where("n > 1").select("gram", "ctx"), ["gram", "ctx"])
             .select("id", "mark", (F.col("pos") - F.col("left")).alias("start"),
                     (F.col("pos") + F.col("right")).alias("stop")))
    # Anchors with a context that occurs once beside others: the edges of repeats.
    kinds = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"),
                                         F.count_if(F.col("n") == 1).alias("single"))
    edges = contexts.join(kinds.where("kinds > 1 and single > 0").drop("single"), "gram")
    asked = (edges.select("at.id", "at.mark", "kinds", F.struct("at.pos", "at.left", "at.right", "gram", "n").alias("a"))
             .groupBy("id", "mark").agg(F.collect_list("a").alias("asked")))  # within one text
    cut = written(rows.join(asked, ["id", "mark"]).mapInArrow(
        _cut, "gram long, id long, mark long, pos long, n long, left int, body binary"),
        "repeat-edges")
    large = kinds.where((F.col("kinds") > hot) & (F.col("single") > 0)).select("gram")
    number = max(1, -(-cut.count() // GROUP))
    usual = (cut.join(large, "gram", "left_anti")
             .groupBy(F.pmod(F.xxhash64("gram"), F.lit(number)).alias("share"))
             .applyInPandas(_judge, "id long, mark long, start long, stop long"))
    found = whole.unionByName(usual)
    if large.limit(1).count():
        found = found.unionByName(_hot_spans(cut.join(large, "gram", "left_semi")))
    return found


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        for body, spans in zip(batch.column("body"), batch.column("spans")):
            body = body.as_py()
            runs = covered([(s["start"], s["stop"]) for s in spans.as_py() or ()], len(body))
            kept = b"".join(body[a:b] for a, b in zip([0, *(r[1] for r in runs)],
                                                      [*(r[0] for r in runs), len(body)]))
            for column, value in zip(out, (len(body), len(body) - len(kept), len(runs),
                                           hashlib.sha256(kept).hexdigest(), kept)):
                column.append(value)
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(x, k) for x, k in zip(out, kinds)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT
                    ) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every document; ``kept`` are
    the bytes that stay, which may cut a character."""
    spans = (repeated_spans(docs, key, text, hot).groupBy("id", "mark")
             .agg(F.collect_set(F.struct("start", "stop")).alias("spans")))  # within one text
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), *_keys(key, text))
    return (rows.join(spans, ["id", "mark"], "left").select("doc_id", "body", "spans")
            .mapInArrow(_report, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                 "kept_sha256 string, kept binary"))
