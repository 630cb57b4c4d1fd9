"""Mixing sources to target weights by capped water-filling and seeded repetition.

A source's weight is its share of the mix. No source may be repeated more than ``max_epochs``
times: sources whose share would exceed that are clamped there, and what they cannot take is
shared among the others by weight, again and again until no source is above its cap.

Each document is then taken as often as its source's whole epochs, and the fraction left over is
drawn once from a seeded order. The draw is made in size classes, the largest first, and each
class makes up for the rounding of those before it, so that the words taken come close to the
target even where few long documents hold most of a source.

Defined results: a missing source is a source of its own, ordered last; documents of size 0 and
missing texts take nothing; sources without words get target 0; an empty table gives no rows;
repeated rows are documents of their own that share one draw.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.common import beside, ranked, word_count, written

BUCKETS = 256
WEIGHTS = (1, 2, 3)


def source_targets(sizes: DataFrame, max_epochs: int = 3, weights: tuple[int, ...] = WEIGHTS,
                   budget: int | None = None) -> DataFrame:
    """``source, source_size, weight, target`` of ``sizes`` (source, size).

    Sources by code point, missing last, take ``weights`` in turn; ``budget`` is the size of the
    mix, all sizes unless given. If the caps together are below the budget, every source is
    clamped and the mix is that much smaller. One aggregation per round of the clamping; there
    are at most as many rounds as sources, in practice a few.
    """
    totals = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-totals")
    order = [F.col("source").isNull(), F.col("source")]
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    sources = written(
        ranked(totals, order, "_rank", "mix-rank")
        .withColumn("weight", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_epochs), "mix-sources")
    level, total, clamped = None, budget, -1
    while True:
        # Whole numbers are summed, so that every run finds the same level.
        over = F.lit(False) if level is None else _above(level)
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.count_if(over).alias("n"),
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("weights")).first()
        if total is None:
            total = row["all"] or 0
        if row["n"] == clamped:
            break
        clamped = row["n"]
        if not row["weights"]:  # every source is clamped
            break
        level = (total - row["taken"]) / row["weights"]
    target = F.when(_above(level), F.col("cap").cast("double")) if level is not None else None
    share = F.col("weight") * F.lit(float(level or 0.0))
    return sources.select("source", "source_size", "weight",
                          (share if target is None else target.otherwise(share)).alias("target"))


def _above(level: float) -> Column:
    return F.col("weight") * F.lit(float(level)) > F.col("cap")


def _cells(key: list[Column], size: Column, seed: int) -> tuple[Column, Column]:
    """Size class (floor of log2, -1 for size 0) and draw bucket of a document."""
    kind = F.when(size > 0, F.floor(F.log2(size)).cast("int")).otherwise(F.lit(-1))
    return kind, F.pmod(F.xxhash64(F.lit(seed), *key, size), F.lit(BUCKETS)).cast("int")


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per size class of one source: how many of its draw buckets are taken once more."""
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    whole = int(target // size) if size else 0
    fraction = target / size - whole if size else 0.0
    wanted, got, rows = 0.0, 0, []
    for kind, cells in sorted(pdf.groupby("kind"), reverse=True):
        in_bucket = np.zeros(BUCKETS, dtype=np.int64)
        in_bucket[cells["bucket"].to_numpy()] = cells["words"].to_numpy()
        upto = np.concatenate([[0], np.cumsum(in_bucket)])
        wanted += fraction * upto[-1]
        cut = int(np.argmin(np.abs(got + upto - wanted)))
        got += int(upto[cut])
        rows.append((pdf["source"].iloc[0], int(kind), whole, cut))
    return pd.DataFrame(rows, columns=["source", "kind", "whole", "cut"])


OWN = ["_size", "_kind", "_bucket", "_repeats", "_plan_source", "_plan_kind", "_plan_whole", "_plan_cut"]


def mix(docs: DataFrame, key: list[str], source: str = "source", text: str = "text",
        max_epochs: int = 3, weights: tuple[int, ...] = WEIGHTS, seed: int = 17,
        budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Targets by source, and ``docs`` with ``_size`` and ``_repeats``, its last two columns; where
    ``docs`` has columns of such names, these get longer ones (see ``beside``).

    ``key`` names the columns that, with the size, seed a document's draw. Texts are read where
    they lie; the plan has at most 64 rows a source and is joined by source and size class,
    which also splits a hot source.
    """
    size = word_count(F.col(f"`{text}`"))
    keys = [F.col(f"`{k}`") for k in key]
    kind, bucket = _cells(keys, F.col("size"), seed)
    sizes = written(docs.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)],
                                F.col(f"`{source}`").alias("source"), size.alias("size")),
                    "mix-sizes")
    kind, bucket = _cells([F.col(f"k{i}") for i in range(len(keys))], F.col("size"), seed)
    cells = (sizes.groupBy("source", kind.alias("kind"), bucket.alias("bucket"))
             .agg(F.sum("size").alias("words")))
    targets = written(source_targets(sizes, max_epochs, weights, budget), "mix-targets")
    same = F.col("c.source").eqNullSafe(F.col("t.source"))
    # One row per size class and bucket: at most 64 x 256 a source, whatever its size.
    plan = written(
        cells.alias("c").join(targets.alias("t"), same)
        .select("c.source", "kind", "bucket", "words", "source_size", "target")
        .groupBy("source").applyInPandas(
            _plan, "source string, kind int, whole int, cut int"), "mix-plan")
    own = dict(zip(OWN, beside(docs, *OWN)))
    plan = plan.select(*[F.col(c).alias(own[f"_plan_{c}"]) for c in plan.columns])
    kind, bucket = _cells(keys, F.col(own["_size"]), seed)
    taken = (docs.withColumn(own["_size"], size).withColumn(own["_kind"], kind)
             .withColumn(own["_bucket"], bucket)
             .join(plan, F.col(f"`{source}`").eqNullSafe(F.col(own["_plan_source"]))
                   & (F.col(own["_kind"]) == F.col(own["_plan_kind"])), "left"))
    repeats = (F.coalesce(F.col(own["_plan_whole"]), F.lit(0))
               + (F.col(own["_bucket"]) < F.coalesce(F.col(own["_plan_cut"]), F.lit(0))).cast("int"))
    return targets, taken.withColumn(own["_repeats"], repeats).select(
        *[F.col(f"`{c}`") for c in docs.columns], own["_size"], own["_repeats"])


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix themselves, each as often as the mix takes it."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    _, taken = mix(docs, **settings)
    repeats, (copy,) = F.col(f"`{taken.columns[-1]}`"), beside(taken, "_copy")
    return (taken.where(repeats > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), repeats)))
            .select(*columns))


def expected_targets(totals: dict[str | None, int], max_epochs: int,
                     weights: tuple[int, ...] = WEIGHTS) -> Iterator[tuple[str | None, float]]:
    """The same targets by plain arithmetic over a few sources, for checks."""
    names = sorted((s for s in totals if s is not None)) + [None] * (None in totals)
    share = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap = {s: max_epochs * totals[s] for s in names}
    held: set[str | None] = set()
    while True:
        rest = sum(totals.values()) - sum(cap[s] for s in held)
        free = sum(share[s] for s in names if s not in held)
        more = {s for s in names if s not in held and share[s] * rest / free > cap[s]}
        if not more:
            break
        held |= more
    for s in names:
        yield s, float(cap[s]) if s in held else share[s] * (rest / free)
