"""Groups of texts whose sets of 5-word shingles resemble each other, by several token orders.

A text is lower-cased (A-Z) and cut into words and 5-word shingles, hashed (XXH64, seed 42). Texts
link where the shingles they share are at least 0.8 of those that either has; groups are what
links join. Texts of the same shingles are one item from the start (told by a hash of the set).

Two sets of ``n`` and ``m`` tokens that link share a token among the first ``n - ceil(0.8 n) + 1``
and ``m - ceil(0.8 m) + 1`` of any order of all tokens. The join asks this under several orders, and
only what passes all of them is verified:

1. by hash, with prefixes longer by a tenth of the set, of which two sets that link share as many
   tokens more. An item that shares too few of its prefix with the prefixes of all others links
   with none and goes; mostly copies and texts made of common passages are left.
2. by frequency among those left, rarest first, which keeps common passages out of prefixes. Items
   that share a prefix token are of one family; no link leaves a family. Frequencies are counted
   along one sort by token, which splits tokens that many items have.
3. by two further hashes, asked of the pairs that meet under order 2.

Families stand sorted by set size and are cut into blocks of ``BLOCK`` tokens; a block meets itself
and those blocks of its family whose sizes allow a link. In such a task each set stands once, however
many partners it has: pairs are looked up by prefix token, filtered by size and by every order, and
verified by their whole sets. Pairs already joined are left out, and a task passes on only as many
links as join its items into the same groups, so neither a dense group nor a family of texts that
never link becomes rows for its pairs.

Defined results: fewer than 5 words are one shingle; texts without words (missing, empty, white
space) have no shingles and link with nothing, each its own component; repeated rows and ids are
documents of their own; a missing doc_id is never the smallest unless all of a group are missing;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.llm.common import written
from headway.llm.links import components

WORDS = 5
SHARE = (4, 5)        # 0.8 as a fraction
LONGER = 10           # a prefix by hash is longer by one of so many tokens of its set
BLOCK = 1 << 19       # tokens of a block (a larger set is a block of its own)
MOST = (1 << 31) - 1  # frequency of a token that stands at the edge of a task
AT_ONCE = 1 << 21     # tokens looked up at a time
ORDERS = ((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9), (0xD1B54A32D192ED03, 0x94D049BB133111EB))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a UTF-8 text."""
    parts = (text or b"").lower().split()  # both know ASCII only
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) < WORDS:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    after = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    ends, starts = (after[WORDS - 1:] - 1).tolist(), [0, *after[:-WORDS].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends)),
                                 np.uint64, len(starts)))


def prefix_length(n):
    """Tokens of a set of ``n`` among which a set that links must share one, in any order."""
    part, whole = SHARE
    return n - (part * n + whole - 1) // whole + 1


def _prefix_length(n: Column) -> Column:
    part, whole = SHARE
    return n - F.floor((part * n + (whole - 1)) / whole) + 1


def longer_prefix(n):
    """Tokens of a set of ``n`` among the first of which it shares ``to_share`` with each it links to."""
    return prefix_length(n) + n // LONGER


def to_share(n):
    """The smaller of two sets that link has 0.8 of ``n`` tokens or more, and its longer prefix rules."""
    part, whole = SHARE
    return 1 + (part * n + whole - 1) // whole // LONGER


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    flat = np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(flat)).cast(
        pa.list_(pa.int64()))


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t.as_py()) for t in batch.column("text")]
        item = np.array([xxhash.xxh64_intdigest(f.tobytes(), 7) for f in found], np.uint64)
        once = np.zeros(len(found), bool)  # copies in one batch need one prefix
        once[np.unique(item, return_index=True)[1]] = True
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(item.view(np.int64)),
             pa.array([len(f) for f in found], pa.int64()),
             _lists([f[:longer_prefix(len(f)) if new and len(f) else 0] for f, new in zip(found, once)])],
            names=["doc_id", "mark", "item", "n", "prefix"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (token, item) in order: those whose token several items have, and how many have it.

    The first and the last token of a task may go on in another; in all tasks they count as had by
    ``MOST``. So a token has one frequency wherever it is read. Repeated rows count once.
    """
    def told(token, items, times):
        return pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(np.broadcast_to(token, items.shape), pa.int64()),
             pa.array(np.broadcast_to(times, items.shape), pa.int32())], names=["item", "token", "times"])

    open_, held, border, last = None, [], True, None  # the token that stands open and its items
    for batch in batches:
        tokens, items = (batch.column(c).to_numpy() for c in ("token", "item"))
        if not len(tokens):
            continue
        new = np.concatenate([[last != (tokens[0], items[0])],
                              (tokens[1:] != tokens[:-1]) | (items[1:] != items[:-1])])
        last = tokens[-1], items[-1]
        tokens, items = tokens[new], items[new]
        if not len(tokens):
            continue
        open_ = tokens[0] if open_ is None else open_
        starts = np.flatnonzero(np.concatenate([[tokens[0] != open_], tokens[1:] != tokens[:-1]]))
        if not len(starts):
            held.append(items)
            continue
        held.append(items[:starts[0]])
        before = np.concatenate(held)
        if border or len(before) > 1:
            yield told(open_, before, MOST if border else len(before))
        sizes = np.diff(starts)
        times = np.repeat(sizes, sizes)
        inner, shared = slice(starts[0], starts[-1]), times > 1
        yield told(tokens[inner][shared], items[inner][shared], times[shared])
        open_, held, border = tokens[starts[-1]], [items[starts[-1]:]], False
    if open_ is not None:
        yield told(open_, np.concatenate(held), MOST)


def _shared(rows: DataFrame) -> DataFrame:
    """``item, token, times`` of the rows (token, item) whose token another item has; ranges of token and
    item split a token that many have."""
    return (rows.select("token", "item").repartitionByRange("token", "item")
            .sortWithinPartitions("token", "item").mapInArrow(_counted, "item long, token long, times int"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), _lists([shingles(t.as_py()) for t in batch.column("text")])],
            names=["item", "tokens"])


class Ragged:
    """Lists of token numbers, read many at a time."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)])

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.starts[i]:self.starts[i + 1]]

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def marked(self, marks: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """How many tokens of each of ``lists`` are marked (no list is empty)."""
        out = np.empty(len(lists), np.int64)
        turn = (np.cumsum(self.sizes[lists]) - 1) // AT_ONCE
        for at in np.split(np.arange(len(lists)), np.flatnonzero(np.diff(turn)) + 1):
            part, sizes = lists[at], self.sizes[lists[at]]
            if len(part):
                ends = np.cumsum(sizes)
                places = np.arange(ends[-1]) + np.repeat(self.starts[part] - ends + sizes, sizes)
                out[at] = np.add.reduceat(marks[self.flat[places]].astype(np.int64), ends - sizes)
        return out


def first_tokens(sets: Ragged, values: np.ndarray, order: tuple[int, int]) -> Ragged:
    """The prefix of every set under an order by hash."""
    mask, odd = (np.uint64(x) for x in order)
    mixed = (values ^ mask) * odd
    mixed ^= mixed >> np.uint64(31)
    place = np.empty(len(values), np.int64)
    place[np.argsort(mixed, kind="stable")] = np.arange(len(values))
    owner = sets.owners()
    by = np.lexsort((place[sets.flat], owner))
    sizes = prefix_length(sets.sizes)
    inside = np.arange(len(by)) - np.repeat(sets.starts[:-1], sets.sizes)
    return Ragged(sets.flat[by][inside < np.repeat(sizes, sets.sizes)], sizes)


def spanning_links(tokens: list[np.ndarray], prefixes: list[np.ndarray], first: np.ndarray,
                   other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each item that links join to an earlier one, and the least of its group.

    Pairs are those of an item that is ``first`` with an ``other`` one; ``prefixes`` are the items'
    under the order that looks pairs up, ``tokens`` their whole sets.
    """
    count = len(tokens)
    part, whole = SHARE
    sizes = np.array([len(t) for t in tokens])
    values, flat = np.unique(np.concatenate(tokens), return_inverse=True)
    sets = Ragged(flat, sizes)
    looked = Ragged(np.searchsorted(values, np.concatenate(prefixes)), np.array([len(p) for p in prefixes]))
    further = [first_tokens(sets, values, order) for order in ORDERS]
    # Posting lists of the items that may be the second of a pair.
    owners = looked.owners()
    entered = other[owners]
    by = np.argsort(looked.flat[entered], kind="stable")
    posted = owners[entered][by]
    bounds = np.searchsorted(looked.flat[entered][by], np.arange(len(values) + 1))
    both = first & other
    root, marks = np.arange(count), np.zeros(len(values), bool)
    for u in np.flatnonzero(first):
        met = np.zeros(count, bool)
        for t in looked[u]:
            met[posted[bounds[t]:bounds[t + 1]]] = True
        if both[u]:  # two items that are both meet at the first of them
            met[:u + 1] &= ~both[:u + 1]
        met &= root != root[u]
        near = np.flatnonzero(met)
        near = near[whole * np.minimum(sizes[near], sizes[u]) >= part * np.maximum(sizes[near], sizes[u])]
        for prefix in further:
            if len(near):
                marks[prefix[u]] = True
                near = near[prefix.marked(marks, near) > 0]
                marks[prefix[u]] = False
        if len(near):
            marks[sets[u]] = True
            shared = sets.marked(marks, near)
            marks[sets[u]] = False
            near = near[whole * shared >= part * (sizes[near] + sizes[u] - shared)]
            if len(near):
                joined = np.zeros(count, bool)
                joined[root[near]] = joined[root[u]] = True
                root = np.where(joined[root], np.flatnonzero(joined)[0], root)
    tied = np.flatnonzero(root != np.arange(count))
    return tied, root[tied]


def _cell(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["root", "item"])
    item = pdf["item"].to_numpy()
    tokens = [np.asarray(t, np.int64).view(np.uint64) for t in pdf["tokens"]]
    prefixes = [np.asarray(t, np.int64).view(np.uint64) for t in pdf["prefix"]]
    u, v = spanning_links(tokens, prefixes, pdf["first"].to_numpy(), pdf["other"].to_numpy())
    return pd.DataFrame({"u": item[u], "v": item[v]})


def rare_prefixes(sets: DataFrame) -> DataFrame:
    """``item, n, prefix`` of the items that have, among the first tokens in order of frequency, some
    that another item has too; ``prefix`` holds those."""
    held = (_shared(sets.select(F.explode("tokens").alias("token"), "item")).groupBy("item")
            .agg(F.sort_array(F.collect_list(F.struct("times", "token"))).alias("held"))
            .join(sets.select("item", F.size("tokens").cast("long").alias("n")), "item"))
    # Tokens of one item come first in the order; what they leave of the prefix is shared ones.
    room = (_prefix_length(F.col("n")) - (F.col("n") - F.size("held"))).cast("int")
    return held.withColumn("room", room).where("room > 0").select(
        "item", "n", F.transform(F.slice("held", F.lit(1), F.col("room")), lambda x: x["token"]).alias("prefix"))


def families(prefixes: DataFrame) -> DataFrame:
    """``item, root``: the items that share prefix tokens with others, and what tells families apart."""
    posted = prefixes.select("item", F.explode("prefix").alias("token"))
    least = (posted.groupBy("token").agg(F.min("item").alias("v"), F.max("item").alias("most"))
             .where("v <> most").select("token", "v"))
    edges = posted.join(least, "token").select(F.col("item").alias("u"), "v").where("u <> v")
    found = components(edges, "jaccard-families")
    return found.select(F.col("u").alias("item"), F.col("v").alias("root")).union(
        found.select(F.col("v").alias("item"), F.col("v").alias("root")).distinct())


def blocked(members: DataFrame, size: int) -> DataFrame:
    """``members`` (root, n, item, ...) with ``block``: cuts of ``size`` tokens in order of family
    and set size.

    One sort by ranges over all tasks; of each range only its number of tokens goes to the driver.
    """
    spark = members.sparkSession
    order = ["root", "n", "item"]
    held = written(members.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("at", F.monotonically_increasing_id()), "jaccard-sorted")
    held = held.withColumn("part", F.shiftright("at", 33))
    starts, total = [], 0
    for part, n in sorted(map(tuple, held.groupBy("part").agg(F.sum("n")).collect())):
        starts.append((part, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(starts, "part long, start long"))  # one row per task
    so_far = F.sum("n").over(W.partitionBy("part").orderBy("at").rowsBetween(W.unboundedPreceding, -1))
    return (held.withColumn("so_far", F.coalesce(so_far, F.lit(0))).join(offsets, "part")
            .withColumn("block", F.floor((F.col("start") + F.col("so_far")) / size))
            .drop("at", "part", "start", "so_far"))


def links(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``u, v``: links that join the items of ``sets`` (item, tokens) into their groups."""
    part, whole = SHARE
    prefixes = written(rare_prefixes(sets), "jaccard-prefixes")
    members = families(prefixes).join(prefixes.select("item", "n"), "item")
    members = written(blocked(members, block), "jaccard-members")
    spans = members.groupBy("root", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    one = spans.select("root", F.col("block").alias("a"), F.col("high").alias("high_a"))
    two = spans.select("root", F.col("block").alias("b"), F.col("low").alias("low_b"))
    # Blocks rise in set size, so those behind are too large from some point on.
    cells = one.join(two, "root").where((F.col("a") <= F.col("b"))
                                        & (part * F.col("low_b") <= whole * F.col("high_a")))
    lives = F.col("block") == F.col("a")
    places = [members.join(cells.withColumn("block", F.col(side)), ["root", "block"])
              .where(fits).select("a", "b", "root", "item", first.alias("first"), other.alias("other"))
              for side, fits, first, other in (
                  ("a", whole * F.col("n") >= part * F.col("low_b"), F.lit(True), F.col("a") == F.col("b")),
                  ("b", ~lives & (part * F.col("n") <= whole * F.col("high_a")), F.lit(False), F.lit(True)))]
    rows = (written(places[0].union(places[1]), "jaccard-places").join(sets, "item")
            .join(prefixes.select("item", "prefix"), "item"))
    return rows.groupBy("a", "b").applyInPandas(_cell, "u long, v long")


def resembling(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document."""
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       body.cast("binary").alias("text"), F.xxhash64(body).alias("mark"))
    prints = written(rows.mapInArrow(
        _prints, "doc_id long, mark long, item long, n long, prefix array<long>"), "jaccard-prints")
    # Order 1.
    met = _shared(prints.select(F.explode("prefix").alias("token"), "item")).groupBy("item").count()
    number = F.coalesce("doc_id", F.lit(-1)).alias("number")
    enough = F.col("count") >= 1 + F.floor(F.floor((SHARE[0] * F.col("n") + SHARE[1] - 1) / SHARE[1]) / LONGER)
    # One text of each that is left, found by id and hash; the join leaves repeated rows side by side.
    chosen = (prints.groupBy("item").agg(F.min("n").alias("n"), F.min(F.struct(number, "mark")).alias("one"))
              .join(met, "item").where(enough).select("item", "one.number", "one.mark"))
    texts = rows.select(number, "mark", "text").join(chosen.hint("merge"), ["number", "mark"])
    copy = F.row_number().over(W.partitionBy("number", "mark").orderBy("number"))
    sets = written(texts.withColumn("copy", copy).where("copy = 1").select("item", "text")
                   .mapInArrow(_sets, "item long, tokens array<long>"), "jaccard-sets")
    roots = components(links(sets, block), "jaccard-links")
    least = prints.where("n > 0").groupBy("item").agg(F.min("doc_id").alias("least"))
    tied = roots.select(F.col("u").alias("item"), "v").union(
        roots.select(F.col("v").alias("item"), "v").distinct())
    smallest = least.join(tied, "item", "left").withColumn("root", F.coalesce("v", "item"))
    groups = written(smallest.select("item", "root", "least"), "jaccard-groups")
    ids = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    named = groups.join(ids, "root").select("item", "component_id")
    return (prints.join(named, "item", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def check_sql() -> str:
    """The same groups in the check engine's SQL: every pair that shares a shingle, whole sets."""
    part, whole = SHARE
    return f"""
with recursive parts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then []
    else list_distinct([array_to_string(w[i:i + {WORDS - 1}], ' ')
                        for i in range(1, greatest(len(w) - {WORDS - 2}, 2))]) end as s
  from parts),
distinct_sets as (
  select list_sort(s) as whole, min(doc_id) as item, any_value(len(s)) as n
  from sets where len(s) > 0 group by whole),
tokens as (select item, n, unnest(whole) as token from distinct_sets),
links as (
  select a.item as u, b.item as v
  from tokens a join tokens b on a.token = b.token and a.item <> b.item
  group by a.item, b.item, a.n, b.n
  having {whole} * count(*) >= {part} * (a.n + b.n - count(*))),
reached as (
  select item, item as other from distinct_sets
  union select r.item, l.v from reached r join links l on l.u = r.other),
groups as (select item, min(other) as component_id from reached group by 1)
select d.doc_id, len(d.s)::bigint as n_shingles, coalesce(g.component_id, d.doc_id) as component_id
from sets d left join distinct_sets i on i.whole = list_sort(d.s)
left join groups g on g.item = i.item"""
