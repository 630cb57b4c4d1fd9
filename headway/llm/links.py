"""Connected components of links between distinct items, without any driver-side graph."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from headway.llm.common import written


def local_roots(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions over the given links."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        differ = a != b
        if not differ.any():
            break
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, purpose: str = "links") -> DataFrame:
    """``u, v``: every linked item but the smallest of its component, and that smallest.

    ``edges`` (u, v) may hold either direction and repeats. Rounds of large and small stars: each
    item passes its neighbours on to the smallest it knows, so chains halve and a hub's links are
    rows of a join (which adaptive execution splits), never a list. Each round is written to the
    shared folder; the driver sees a count and a sum.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                 F.least("u", "v").alias("v")).distinct(), purpose)
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(smallest, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(smallest.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        edges = written(small, purpose)
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges
