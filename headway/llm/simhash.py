"""Near-duplicates by SimHash fingerprints and vantage-point trees.

A text is lower-cased (A-Z), cut into words and 3-word shingles, repeats included; each shingle is
hashed (XXH64, seed 42) and a fingerprint bit is set where over half the hashes set it. Texts
link where their fingerprints differ in at most ``radius`` bits.

Equal fingerprints are one item from the start, so a group of copies is one row however large.
A vantage-point tree over a bounded sample of the fingerprints divides the space into shards:
inside and outside the median Hamming distance of a vantage point, again and again. Every
fingerprint lives in one shard and visits those shards inside a border it lies beyond that the
triangle bound cannot rule out for its radius, so every pair meets once. Inside a shard the division goes on over the shard's own fingerprints, down to
small blocks that are compared directly. A shard passes on only as many links as join its
fingerprints into the same groups (a spanning star each), so a dense group never becomes all its
pairs; groups are then joined across shards.

Defined results: a text without words (missing, empty, white space) has fingerprint 0 and links
like any other; fewer than 3 words are one shingle; repeated rows and repeated ids are documents
of their own; a missing doc_id is never the smallest unless all of a group are missing; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from headway.llm.common import beside, written
from headway.llm.links import components, local_roots

RADIUS = 2
SHARD = 4096        # fingerprints a shard aims at
SAMPLE = 1 << 16    # fingerprints the dividing tree is built from, at most
BLOCK = 192         # fingerprints compared directly
CHUNK = 1 << 15     # shingles counted at once


def fingerprint(text: bytes | None) -> int:
    """The 64 bits of a UTF-8 text, as a signed number."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) < 3:
        starts, ends = [0], [len(joined)]
    else:
        after = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        ends = (after[2:] - 1).tolist()
        starts = [0, *after[:-3].tolist()]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), CHUNK):
        span = zip(starts[i:i + CHUNK], ends[i:i + CHUNK])
        hashes = np.array([digest(joined[a:b], 42) for a, b in span], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        prints = [fingerprint(t.as_py()) for t in text]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(prints, pa.int64())],
            names=["doc_id", "mark", "print"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, mark, print``: ``mark`` is a hash of the text, which tells rows of one id apart."""
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       body.cast("binary").alias("text"), F.xxhash64(body).alias("mark"))
    return rows.mapInArrow(_fingerprints, "doc_id long, mark long, print long")


def distance(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Split:
    """A vantage point, the distance that divides, and what lies on either side."""

    def __init__(self, point, middle, inside, outside):
        self.point, self.middle, self.inside, self.outside = point, middle, inside, outside


def grow(prints: np.ndarray, leaves: int, rng: np.random.Generator) -> Split | None:
    """A tree of about ``leaves`` shards; None is a shard."""
    if leaves < 2 or len(prints) < 4:
        return None
    point = prints[rng.integers(len(prints))]
    far = distance(prints, point)
    middle = int(np.median(far))
    near = far <= middle
    if near.all():
        middle -= 1
        near = far <= middle
    if not near.any() or near.all():
        return None
    inner = max(1, round(leaves * near.mean()))
    return Split(point, middle, grow(prints[near], inner, rng),
                 grow(prints[~near], max(1, leaves - inner), rng))


def route(tree: Split | None, prints: np.ndarray, radius: int
          ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, positions that live there, positions that visit it) for every shard reached."""
    number = 0

    def down(node, home, guest):
        nonlocal number
        if node is None:
            yield number, home, guest
            number += 1
            return
        own, other = distance(prints[home], node.point), distance(prints[guest], node.point)
        # Pairs across the border are met on the inside: who lives outside visits it where the
        # bound allows; guests go on to each side that the bound allows.
        callers = home[(own > node.middle) & (own <= node.middle + radius)]
        yield from down(node.inside, home[own <= node.middle],
                        np.concatenate([callers, guest[other <= node.middle + radius]]))
        yield from down(node.outside, home[own > node.middle],
                        guest[other > node.middle - radius])

    yield from down(tree, np.arange(len(prints)), np.zeros(0, np.int64))


def near_pairs(prints: np.ndarray, home: np.ndarray, guest: np.ndarray, radius: int,
               rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (home, home or guest) at most ``radius`` bits apart, dividing as above."""
    if not len(home):
        return
    tree = None
    if len(home) > BLOCK:
        tree = grow(prints[home], 2, rng)
    if tree is None:
        everyone = np.concatenate([home, guest])
        for i in range(0, len(home), BLOCK):
            rows = home[i:i + BLOCK]
            a, b = np.nonzero(distance(prints[rows][:, None], prints[everyone][None, :]) <= radius)
            keep = rows[a] != everyone[b]
            yield rows[a[keep]], everyone[b[keep]]
        return
    own, other = distance(prints[home], tree.point), distance(prints[guest], tree.point)
    middle = tree.middle
    inner = np.concatenate([home[(own > middle) & (own <= middle + radius)],
                            guest[other <= middle + radius]])
    outer = guest[other > middle - radius]  # pairs across the border are met on the inside
    yield from near_pairs(prints, home[own <= middle], inner, radius, rng)
    yield from near_pairs(prints, home[own > middle], outer, radius, rng)


def _star(radius: int, pdf: pd.DataFrame) -> pd.DataFrame:
    prints = pdf["print"].to_numpy().view(np.uint64)
    lives = pdf["lives"].to_numpy()
    home, guest = np.flatnonzero(lives), np.flatnonzero(~lives)
    root = np.arange(len(prints))
    held, size = [], 0

    def settle():
        nonlocal root
        a = np.concatenate([x for x, _ in held])
        b = np.concatenate([y for _, y in held])
        node = np.arange(len(root))
        root = local_roots(np.concatenate([a, node]), np.concatenate([b, root]), len(root))

    for pair in near_pairs(prints, home, guest, radius, np.random.default_rng(7)):
        held.append(pair)
        size += len(pair[0])
        if size > 1_000_000:  # keep memory flat in dense groups
            settle()
            held, size = [], 0
    if held:
        settle()
    tied = np.flatnonzero(root != np.arange(len(root)))
    signed = prints.view(np.int64)
    return pd.DataFrame({"u": signed[tied], "v": signed[root[tied]]})


def near_links(items: DataFrame, radius: int = RADIUS, shard: int = SHARD,
               sample: int = SAMPLE) -> DataFrame:
    """Links ``u, v`` that join the distinct fingerprints of ``items`` (print) into groups.

    Exact: every pair within ``radius`` meets in the shard of one of the two. The tree comes from at most
    ``sample`` fingerprints, those first by hash, the only ones the driver sees.
    """
    count = items.count()
    leaves = max(1, min(-(-count // shard), sample // 32))
    tree = None
    if leaves > 1:
        seen = items.orderBy(F.xxhash64("print"), "print").limit(min(sample, leaves * 64)).collect()
        tree = grow(np.array([r["print"] for r in seen], np.int64).view(np.uint64), leaves,
                    np.random.default_rng(7))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column("print").to_numpy(zero_copy_only=False)
            for number, home, guest in route(tree, signed.view(np.uint64), radius):
                if len(home) + len(guest):
                    lives = np.arange(len(home) + len(guest)) < len(home)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(lives), number, np.int32)),
                         pa.array(signed[np.concatenate([home, guest])]), pa.array(lives)],
                        names=["shard", "print", "lives"])

    routed = items.select("print").mapInArrow(send, "shard int, print long, lives boolean")
    return routed.groupBy("shard").applyInPandas(lambda pdf: _star(radius, pdf), "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    radius: int = RADIUS) -> DataFrame:
    """``doc_id, mark, print, root, component_id`` for every document; ``root`` is the smallest
    fingerprint of the group, which tells groups apart even where ids repeat."""
    prints = written(fingerprints(docs, key, text), "simhash-prints")
    items = written(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-items")
    roots = components(near_links(items, radius), "simhash-links")
    rooted = (items.join(roots, items["print"] == roots["u"], "left")
              .select("print", "least", F.coalesce("v", "print").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = written(rooted.join(smallest, "root").select("print", "root", "component_id"),
                     "simhash-groups")
    return prints.join(groups, "print").select("doc_id", "mark", "print", "root", "component_id")


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the smallest id, by text hash where ids repeat."""
    near = written(near_duplicates(docs, key, text, radius), "simhash-near")
    return first_of_groups(docs, near, key, text)


def first_of_groups(docs: DataFrame, near: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with one document of each group that ``near`` (doc_id, mark, root) tells."""
    first = (near.groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"))
             .select("first.doc_id", "first.mark"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    spot, number, copy = beside(docs, "_hash", "_id", "_copy")

    def keyed(doc_id, mark) -> list:
        return [F.xxhash64(doc_id, mark).alias(spot), F.coalesce(doc_id, F.lit(-1)).alias(number)]

    marked = docs.select("*", *keyed(F.col(f"`{key}`").cast("long"),
                                     F.xxhash64(F.col(f"`{text}`").cast("string"))))
    first = first.select(*keyed(F.col("doc_id"), F.col("mark")))
    same = W.partitionBy(spot, number).orderBy(spot)  # the join leaves the rows so sorted
    return (marked.join(first, [spot, number], "left_semi")
            .withColumn(copy, F.row_number().over(same)).where(F.col(copy) == 1).select(*columns))
