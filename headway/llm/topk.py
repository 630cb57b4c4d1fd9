"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Rows are numbered by one distributed sort and cut into blocks; queries are cut into blocks of
their own, and a block of queries meets every block of rows in a task of bounded size. There the
rows of the block stand in one sorted list per dimension. A query goes down all lists at once,
from the end that its component favours, scores every row it meets, and stops as soon as its k-th
best score is above the bound: the score of a row that would have in every dimension the value
reached there. Rows not met cannot be better than the bound, so the k best of the block are exact;
the k best of all blocks come from a ranking that keeps k rows per query and task before it moves
them.

Defined results: components become floor(64 * x) of the double x; vectors that are missing or
hold missing or non-finite components, and rows without an id, take no part; shorter vectors count
as 0 in what they lack; equal scores go to the smaller id; repeated rows are rows of their own (a
query leaves out only itself, and each repeat of a query has its own answer); with fewer than k
others a query gets all; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.llm.common import ranked

K = 20
SCALE = 64
ROWS = 8192       # rows of a block
QUERIES = 512     # queries of a block
FIRST = 16        # depth of the first look at the bound
STEPS = 4         # times deeper each further look


def _numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                         & (F.abs(x) < float("inf")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class Lists:
    """The rows of a block by dimension."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        order = np.argsort(rows, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T.astype(np.int32))  # dimension, place
        self.sorted = np.ascontiguousarray(np.take_along_axis(rows, order, axis=0).T)
        self.largest = float(np.abs(rows.astype(np.float64)).max(initial=0))
        self.as_kind = {np.dtype(np.int64): rows}

    def of_kind(self, query: np.ndarray) -> np.ndarray:
        """The rows in the smallest type that holds every score of the query exactly."""
        most = self.largest * float(np.abs(query.astype(np.float64)).sum())
        kind = np.dtype(np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64)
        if kind not in self.as_kind:
            self.as_kind[kind] = self.rows.astype(kind)
        return self.as_kind[kind]

    def best(self, query: np.ndarray, own: int, k: int, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best rows but ``own``; equal scores by smaller ``tie``."""
        n = len(self.rows)
        rows = self.of_kind(query)
        asked = query.astype(rows.dtype)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met, depth = np.zeros(n, bool), FIRST
        while True:
            if depth < n:
                met[self.order[up, n - depth:]] = True
                met[self.order[down, :depth]] = True
            seen = np.flatnonzero(met)
            if depth >= n or len(seen) > n // 2:  # what is left costs less than looking for it
                scores = rows @ asked
                seen = np.arange(n)
            else:
                scores = rows[seen] @ asked
            keep = seen != own
            seen, scores = seen[keep], scores[keep]
            if len(seen) >= n - 1:
                break
            if len(seen) >= k:
                kth = np.partition(scores, len(seen) - k)[len(seen) - k]
                bound = query[up] @ self.sorted[up, n - depth] + query[down] @ self.sorted[down, depth - 1]
                if kth > bound:  # a row that equals the k-th may have the smaller id
                    break
            depth *= STEPS
        if len(seen) > k:
            top = np.flatnonzero(scores >= np.partition(scores, len(seen) - k)[len(seen) - k])
            seen, scores = seen[top], scores[top]
        order = np.lexsort((tie[seen], -scores))[:k]
        return seen[order], scores[order].astype(np.int64)


def _meet(k: int, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    empty = np.zeros(0, np.int64)
    out: list[tuple] = [(empty,) * 5]
    if len(rows) and len(queries):
        width = max(map(len, (*rows["v"], *queries["asked_v"])))
        lists, asked = Lists(_matrix(rows["v"], width)), _matrix(queries["asked_v"], width)
        number, ids = rows["number"].to_numpy(), rows["vec_id"].to_numpy()
        place = {int(x): i for i, x in enumerate(number)}
        for i, (query, at) in enumerate(zip(queries["query_id"], queries["query"])):
            found, scores = lists.best(asked[i], place.get(int(at), -1), k, ids)
            out.append((np.full(len(found), at), np.full(len(found), query), ids[found], scores,
                        number[found]))
    names = ("query", "query_id", "vec_id", "score", "number")
    return pd.DataFrame({n: np.concatenate(x) for n, x in zip(names, zip(*out))})


def top_k(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id",
          vector: str = "embedding", rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each row that ``is_query``."""
    named = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"),
                           F.col(f"`{vector}`").alias("_v"), is_query.alias("asked"))
    # Both sides of the meeting come from this one table, so its columns are named apart.
    usable = (named.where(_usable(F.col("_v")) & F.col("vec_id").isNotNull())
              .select("vec_id", _numbers(F.col("_v")).alias("v"),
                      F.coalesce("asked", F.lit(False)).alias("asked")))
    placed = ranked(usable, [F.col("vec_id"), F.col("v")], "number", "topk-rows")
    row_blocks = -(-placed.count() // rows)
    asked = placed.where("asked").select(F.col("number").alias("query"), F.col("vec_id").alias("query_id"),
                                         F.col("v").alias("asked_v"))
    query_blocks = max(1, -(-asked.count() // queries))
    # Blocks of the rows and of the queries meet once each; both sides of a task are bounded.
    each_row = (placed.drop("asked")
                .withColumn("block", F.floor(F.col("number") / rows).cast("int"))
                .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    each_query = (asked.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int"))
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, row_blocks - 1))))))
    met = (each_row.groupBy("block", "group").cogroup(each_query.groupBy("block", "group"))
           .applyInPandas(lambda a, b: _meet(k, a, b),
                          "query long, query_id long, vec_id long, score long, number long"))
    best = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "number")
    return (met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def check_sql(divisor: int, k: int = K) -> str:
    """The same answers in the check engine's SQL, every query against every row."""
    return f"""
with usable as (
  select vec_id, row_number() over (order by vec_id) as number,
         [floor({SCALE} * x::double) for x in embedding] as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select q.number, q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from usable q join usable c on q.number <> c.number
  where q.vec_id % {divisor} = 0),
best as (
  select *, row_number() over (partition by number order by score desc, vec_id) as rank from scored)
select query_id, rank::int as rank, vec_id, score from best where rank <= {k}"""
