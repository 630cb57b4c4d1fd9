"""Hard negatives by threshold joins over an inverted index with norm bounds.

An anchor's positives are its best rows of the same label; for each, the hard negatives are the
best rows of other labels whose score lies in a window below the positive's.

Rows are numbered by one distributed sort by label and cut into blocks; anchors are cut into
groups, and a group meets a block in a task of bounded size (for positives only the blocks that
hold the anchors' label). In a task the rows are indexed by dimension, in one order of dimensions
for all. A row's entry in a dimension stands under the norm of the row up to that dimension. At a
threshold ``t`` an anchor of norm ``a`` reads of each dimension only the entries of norm ``t / a``
and more: what it leaves out of a row is its first dimensions, whose share of the score is below
``t`` by the norms. It adds up partial scores, drops the rows whose partial score and the norms of
what is left stay below ``t``, and completes the others. The dimensions that hold nearly all of the
rows' squares would be read whole by any anchor: all anchors of a group read them at once, as one
product of matrices, and a search goes on from there. Positives start at a threshold that partial
scores less what is left show to leave enough rows. If the windows are not full the threshold
is lowered: the lists are read on from where they stood, and nothing is added up twice. So a block
gives its best rows exactly, and the best of all blocks come from rankings that keep a few rows per
anchor and task before they move them.

Defined results: components become floor(scale * x) of the double x; rows with a missing label, a
missing vector, missing or non-finite components or no id take no part; shorter vectors count as 0
in what they lack; equal scores go to the smaller id; repeated rows are rows of their own (an
anchor leaves out only itself, each repeat of an anchor has its own answer); where a window or a
label holds fewer rows all are given, so a positive of a negative score, whose window is empty,
gives none; scores beyond 2^62 are refused with an error; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.llm.common import ranked

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)    # hundredths of the positive's score
ROWS = 8192          # rows of a block
ANCHORS = 512        # anchors of a group
AT_ONCE = 128        # anchors of a product of matrices
LOWER = 0.8          # what a threshold that left a window open is multiplied by
LEAST = 0.05         # share of the highest possible score below which all rows are completed
SLACK = 1e-9         # relative allowance for rounding in the bounds
HEAD = 0.05          # share of the rows' squares in the dimensions that each anchor reads for itself


class Index:
    """The rows of a block by dimension; within one by the norm of the row up to there, falling."""

    def __init__(self, rows: np.ndarray):
        squares = rows.astype(np.float64) ** 2
        self.dims = np.argsort(squares.sum(axis=0), kind="stable")  # leaves out as many as it can
        shares = np.cumsum(np.sort(squares.sum(axis=0)))
        self.head = int((shares <= HEAD * shares[-1]).sum()) if len(shares) else 0
        self.rows = np.ascontiguousarray(rows[:, self.dims])
        self.norms = np.zeros((len(rows), rows.shape[1] + 1))
        np.sqrt(np.cumsum(squares[:, self.dims], axis=1), out=self.norms[:, 1:])
        self.longest = float(self.norms[:, -1].max(initial=0))
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.columns = {np.int64: np.ascontiguousarray(self.rows.T),
                        np.float64: np.ascontiguousarray(self.rows.T.astype(np.float64))}


    def entries(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows in the order of dimension ``d``, and their norms below zero, which rise; sorted
        when first asked for."""
        if d not in self.lists:
            below = -self.norms[:, d + 1]
            order = np.argsort(below, kind="stable")
            self.lists[d] = order, below[order]
        return self.lists[d]


class Search:
    """One anchor on its way down the thresholds of an index."""

    def __init__(self, index: Index, anchor: np.ndarray, tail: np.ndarray | None = None):
        """``tail``: partial scores over the dimensions behind the head, read whole (``tails``)."""
        asked = anchor[index.dims]
        norms = np.sqrt(np.cumsum(asked.astype(np.float64) ** 2))
        self.norms = np.concatenate([[0.0], norms])
        self.highest = self.norms[-1] * index.longest
        if self.highest >= 2.0 ** 62:
            raise ValueError("scores beyond 2^62: scale the vectors down")
        kind = np.float64 if self.highest < 2.0 ** 52 else np.int64  # whole numbers in either
        self.index, self.anchor, self.columns = index, asked.astype(kind), index.columns[kind]
        self.partial = np.zeros(len(index.rows), kind)
        self.left = np.full(len(index.rows), len(index.dims))  # dimensions of each row not read yet
        self.read = np.zeros(len(index.dims), np.int64)
        self.entries = 0    # read so far
        self.completed = 0  # rows completed so far
        if tail is not None:
            self.partial[:] = tail
            self.left[:] = index.head
            self.read[index.head:] = len(index.rows)
            self.entries = int(self.read.sum())

    def _most(self) -> np.ndarray:
        """What the dimensions not read yet can add to or take from the score of each row."""
        return self.index.norms[np.arange(len(self.left)), self.left] * self.norms[self.left]

    def reached(self, k: int, own: int) -> float:
        """A threshold that at least ``k`` rows but ``own`` reach, as far as they have been read."""
        low = self.partial - self._most() - SLACK * (self.highest + 1)
        if own >= 0:
            low[own] = -np.inf
        return float(np.partition(low, -k)[-k]) if len(low) >= k else -np.inf

    def at_least(self, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all rows that score ``threshold`` or more, which never rises."""
        index, count = self.index, len(self.left)
        norm = threshold / self.norms[-1] * (1 - SLACK) if threshold > 0 and self.norms[-1] else 0.0
        ends = self.read.copy()
        for d in np.flatnonzero(self.read < count):
            ends[d] = max(ends[d], index.entries(d)[1].searchsorted(-norm, "right"))
        whole = (ends == count) & (self.read == 0)
        tail = len(whole) - int(np.argmin(np.append(whole[::-1], False)))  # from here on read whole
        if tail < len(whole):
            self.partial += self.anchor[tail:] @ self.columns[tail:]
            self.left -= len(whole) - tail
        for d in np.flatnonzero(ends[:tail] > self.read[:tail]):
            at = index.entries(d)[0][self.read[d]:ends[d]]
            self.partial[at] += self.anchor[d] * self.columns[d, at]
            self.left[at] -= 1
        self.entries += int((ends - self.read).sum())
        self.read = ends
        near = np.flatnonzero(self.partial + self._most() + SLACK * (self.highest + 1) >= threshold)
        self.completed += len(near)
        open_ = int(self.left[near].max(initial=0))
        rest = np.arange(open_) < self.left[near, None]
        scores = (self.partial[near] + (index.rows[near, :open_] * rest) @ self.anchor[:open_]).astype(np.int64)
        good = scores >= threshold
        return near[good], scores[good]

    def downwards(self, first: float, last: float) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
        """(whether it is the last, places, scores) at falling thresholds from ``first`` to ``last``."""
        threshold = min(first, self.highest)
        while True:
            end = threshold <= last or threshold <= self.highest * LEAST
            yield end, *self.at_least(last if end else threshold)
            if end:
                return
            threshold *= LOWER


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def tails(index: Index, anchors: np.ndarray) -> Iterator[np.ndarray | None]:
    """Partial scores of each of ``anchors`` with all rows over the dimensions behind the head; None
    where they would not be exact."""
    asked = anchors[:, index.dims].astype(np.float64)
    if not np.sqrt((asked ** 2).sum(axis=1).max(initial=0)) * index.longest < 2.0 ** 52:
        yield from [None] * len(anchors)
        return
    behind = index.columns[np.float64][index.head:]
    for first in range(0, len(anchors), AT_ONCE):
        yield from asked[first:first + AT_ONCE, index.head:] @ behind


def best_positives(index: Index, ids: np.ndarray, anchor: np.ndarray, own: int, k: int,
                   tail: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best rows but ``own``."""
    search = Search(index, anchor, tail)
    first = search.reached(k, own) if tail is not None else np.inf
    for end, places, scores in search.downwards(first, -np.inf):
        other = places != own
        places, scores = places[other], scores[other]
        if end or len(places) >= k:
            top = _best(scores, ids[places], k)
            return places[top], scores[top]


def best_negatives(index: Index, ids: np.ndarray, may: np.ndarray, anchor: np.ndarray,
                   positives: np.ndarray, k: int, window: tuple[int, int], tail: np.ndarray | None = None
                   ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(positive, places, scores): the k best rows that ``may`` count in each positive's window."""
    low, high = window
    open_ = {i: (low * s, high * s) for i, s in enumerate(positives.tolist()) if low * s <= high * s}
    if not open_:
        return
    top = max(h for _, h in open_.values()) / 100
    last = min(lo for lo, _ in open_.values()) // 100
    # No window holds anything at its very top: the first threshold is a step below.
    for end, places, scores in Search(index, anchor, tail).downwards(max(top * LOWER, last), last):
        good = may[places]
        places, scores = places[good], scores[good]
        for i, (lo, hi) in list(open_.items()):
            inside = np.flatnonzero((100 * scores >= lo) & (100 * scores <= hi))
            if end or len(inside) >= k:
                best = inside[_best(scores[inside], ids[places[inside]], k)]
                yield i, places[best], scores[best]
                del open_[i]
        if not open_:
            return


def _numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                         & (F.abs(x) < float("inf")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    if len(vectors) and all(len(v) == width for v in vectors):
        return np.concatenate(vectors.to_list()).astype(np.int64).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _matrices(rows: pd.DataFrame, anchors: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    width = max(map(len, (*rows["v"], *anchors["asked_v"])))
    return _matrix(rows["v"], width), _matrix(anchors["asked_v"], width)


def _frame(names: tuple[str, ...], parts: list[tuple]) -> pd.DataFrame:
    empty = (np.zeros(0, np.int64),) * len(names)
    return pd.DataFrame({n: np.concatenate(x).astype(np.int64)
                         for n, x in zip(names, zip(*[empty, *parts]))})


def _positives(k: int, rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
    out: list[tuple] = []
    if len(rows) and len(anchors):
        all_rows, asked = _matrices(rows, anchors)
        labels = rows["label"].to_numpy()
        for label, mine in anchors.reset_index(drop=True).groupby("asked_label").indices.items():
            same = np.flatnonzero(labels == label)
            if not len(same):
                continue
            index = Index(all_rows[same])
            ids, number = (rows[c].to_numpy()[same] for c in ("vec_id", "number"))
            for i, tail in zip(mine, tails(index, asked[mine])):
                at = int(anchors["anchor"].iloc[i])
                found, scores = best_positives(index, ids, asked[i],
                                               int(np.searchsorted(number, at)) if at in number else -1, k, tail)
                out.append((np.full(len(found), at), number[found], ids[found], scores))
    return _frame(("anchor", "positive", "positive_id", "positive_score"), out)


def _negatives(k: int, window: tuple[int, int], rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
    out: list[tuple] = []
    if len(rows) and len(anchors):
        all_rows, asked = _matrices(rows, anchors)
        index = Index(all_rows)
        ids, number, labels = (rows[c].to_numpy() for c in ("vec_id", "number", "label"))
        for i, (at, label, positives, tail) in enumerate(zip(
                anchors["anchor"], anchors["asked_label"], anchors["positives"], tails(index, asked))):
            scores = np.array([p["positive_score"] for p in positives], np.int64)
            for p, found, got in best_negatives(index, ids, labels != label, asked[i], scores, k, window,
                                                 tail):
                out.append((np.full(len(found), at), np.full(len(found), positives[p]["positive"]),
                            number[found], ids[found], got))
    return _frame(("anchor", "positive", "number", "negative_id", "negative_score"), out)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, key: str = "vec_id",
                   vector: str = "embedding", scale: int = SCALE, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, rows: int = ROWS,
                   anchors: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for each row
    that ``is_anchor`` and each of its best ``positives``: the best ``negatives`` of other labels
    that score between the hundredths ``window`` of the positive's score."""
    named = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"),
                           F.col(f"`{vector}`").alias("_v"), label.cast("long").alias("label"),
                           F.coalesce(is_anchor, F.lit(False)).alias("asked"))
    usable = (named.where(_usable(F.col("_v")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
              .select("vec_id", "label", "asked", _numbers(F.col("_v"), scale).alias("v")))
    placed = ranked(usable, [F.col("label"), F.col("vec_id"), F.col("v")], "number", "negatives-rows")
    placed = placed.withColumn("block", F.floor(F.col("number") / rows).cast("int"))
    asked = placed.where("asked").select(
        F.col("number").alias("anchor"), F.col("vec_id").alias("anchor_id"),
        F.col("label").alias("asked_label"), F.col("v").alias("asked_v"))
    groups = max(1, -(-asked.count() // anchors))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int"))
    every = placed.drop("asked").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    # Positives lie in the blocks of the anchor's label: neighbours, as rows are sorted by it.
    where = placed.groupBy("label").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    to_own = (asked.join(where.withColumnRenamed("label", "asked_label"), "asked_label")
              .withColumn("block", F.explode(F.sequence("first", "last"))).drop("first", "last"))
    met = (every.groupBy("block", "group").cogroup(to_own.groupBy("block", "group"))
           .applyInPandas(lambda a, b: _positives(positives, a.sort_values("number"), b),
                          "anchor long, positive long, positive_id long, positive_score long"))
    order = W.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    best = (met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
            .groupBy("anchor").agg(F.collect_list(F.struct("positive", "positive_id", "positive_score"))
                                   .alias("positives")))
    with_positives = asked.join(best, "anchor")

    last = placed.agg(F.max("block")).first()[0]
    to_all = with_positives.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last or 0))))
    met = (every.groupBy("block", "group").cogroup(to_all.groupBy("block", "group"))
           .applyInPandas(lambda a, b: _negatives(negatives, window, a, b),
                          "anchor long, positive long, number long, negative_id long, negative_score long"))
    order = W.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative_id", "number")
    hard = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    told = with_positives.select("anchor", "anchor_id", F.explode("positives").alias("p")).select(
        "anchor", "anchor_id", "p.*")
    return hard.join(told, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def check_sql() -> str:
    """The same rows in the check engine's SQL, every anchor against every row."""
    low, high = WINDOW
    return f"""
with usable as (
  select vec_id, row_number() over (order by vec_id) as number,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor({SCALE} * x::double) for x in embedding] as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select a.number as anchor, a.vec_id as anchor_id, r.number, r.vec_id, a.label = r.label as same,
         list_inner_product(a.v, r.v)::bigint as score
  from usable a join usable r on a.number <> r.number where a.vec_id % 50 = 0),
positives as (
  select *, row_number() over (partition by anchor order by score desc, vec_id, number) as place
  from scored where same qualify place <= {POSITIVES}),
negatives as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id,
         p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor, p.number
                            order by n.score desc, n.vec_id, n.number) as rank
  from positives p join scored n on n.anchor = p.anchor and not n.same
   and {low} * p.score <= 100 * n.score and 100 * n.score <= {high} * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from negatives where rank <= {NEGATIVES}"""
