"""Language identification by Bayesian fusion of text, markup, address and host.

Four kinds of evidence, each a likelihood or prior over the languages:

- the text: byte trigrams under a smoothed multinomial model per language, fitted on a bounded
  sample of distinct labelled texts (``SAMPLE`` a language), scored over whole texts;
- the language that a page's markup declares, through a table of how often each declaration goes
  with each language;
- the address's last label, through a table of the same kind;
- the host: its own counts of languages, smoothed towards its suffix's, and those towards all.

Tables and priors are grouped aggregations over all rows of the text's own verdicts. A document of
several pages has the evidence of all of them. The classes
include ``und`` (no known language: every trigram as likely as any other), and documents whose
best class is ``und``, whose best posterior is under ``least`` or that hold no letters are rejected.

Defined results: missing and empty texts are ``und`` and rejected; missing markup, suffix or host
is no evidence; repeated rows are judged alike, ties go to the language first by name; an empty
table gives no rows; further columns are ignored, texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from headway.llm.common import beside, table, written

SAMPLE = 400          # distinct labelled texts a language that the text model is fitted on, at most
BLOCK = 64            # languages scored at once
HELD = 1 << 21        # trigram cells of texts scored at once
CELLS = 1 << 16       # hashed trigrams
UNKNOWN = "und"
TEXT_WEIGHT = 0.2     # trigrams overlap, so a text counts as a fifth of its trigrams
UNKNOWN_PRIOR = 1e-3
HOST_STRENGTH = 20.0  # rows of its suffix's mix that a host starts with
SUFFIX_STRENGTH = 50.0
FINE = float(1 << 32)  # logs are added in steps of one part of this
MARKUP = r"(?is)<html[^>]*?\slang\s*=\s*[\"']?\s*([A-Za-z]{2,3})"


def trigram_cells(text: bytes) -> np.ndarray:
    """Hashed lower-case byte trigrams; digits and ASCII signs count as spaces."""
    raw = _FOLD[np.frombuffer(text, np.uint8)].astype(np.uint32)
    if len(raw) < 3:
        raw = np.pad(raw, (0, 3 - len(raw)), constant_values=32)
    keys = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return (keys * np.uint32(2654435761)) >> np.uint32(16)


def _folded() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[:128] = 32
    for c in range(ord("a"), ord("z") + 1):
        fold[c] = fold[c - 32] = c
    return fold


_FOLD = _folded()


def fit(docs: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE,
        seed: int = 5) -> tuple[list[str], DataFrame]:
    """Language names, and ``lang, cells, counts`` with the trigram cells of each one's sample.

    Distinct texts are counted and drawn by hash at a rate that yields ``sample`` a language, or
    all where there are no more, so that only these texts move; a window cuts what is too much.
    """
    rows = docs.select(F.lower(F.col(f"`{label}`").cast("string")).alias("lang"),
                       F.col(f"`{text}`").cast("string").alias("text")).where(
        "lang is not null and lang <> 'und' and text is not null")
    rows = rows.withColumn("mark", F.xxhash64(F.lit(seed), "text"))
    # One row per language reaches the driver and goes back to every task.
    counts = rows.select("lang", "mark").distinct().groupBy("lang").count().collect()
    rates = docs.sparkSession.createDataFrame(
        [(r["lang"], 1.5 * sample / r["count"]) for r in counts], "lang string, rate double")
    drawn = (rows.join(F.broadcast(rates), "lang")
             .where(F.pmod("mark", F.lit(1 << 20)) < F.col("rate") * (1 << 20))
             .dropDuplicates(["lang", "mark"]))
    order = W.partitionBy("lang").orderBy("mark")
    drawn = drawn.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CELLS, np.int64)
        for t in pdf["text"]:
            total += np.bincount(trigram_cells(t.encode()), minlength=CELLS)
        cells = np.flatnonzero(total)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "cells": [cells.astype("<u4").tobytes()],
                             "counts": [total[cells].tobytes()]})

    fitted = written(drawn.select("lang", "text").groupBy("lang")
                     .applyInPandas(count, "lang string, cells binary, counts binary"),
                     "langid-model")
    return sorted(r["lang"] for r in fitted.select("lang").collect()), fitted


def likelihoods(fitted: DataFrame, names: list[str]) -> np.ndarray:
    """Log likelihoods by trigram cell of the languages named."""
    got = {}
    for r in fitted.where(F.col("lang").isin(names)).collect():
        got[r["lang"]] = total = np.zeros(CELLS, np.int64)
        total[np.frombuffer(r["cells"], "<u4")] = np.frombuffer(r["counts"], np.int64)
    model = [np.log((got[n] + 0.5) / (got[n].sum() + 0.5 * CELLS)) for n in names]
    return np.array(model, np.float32)


def text_scores(docs: DataFrame, fitted: DataFrame, names: list[str], columns: list[str],
                text: str = "text") -> DataFrame:
    """``columns`` and ``scores``: weighted log likelihoods by language, then by ``und``; empty
    for a text without letters. Driver and tasks hold the model of ``BLOCK`` languages at a time."""
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(np.ascontiguousarray(likelihoods(fitted, names[i:i + BLOCK]).T))
              for i in range(0, len(names), BLOCK)]
    flat = -float(np.log(CELLS))

    def score(held: list[tuple]) -> Iterator[list[float]]:
        parts: list[list] = [[] for _ in held]
        for block in blocks:
            by_cell = block.value
            for part, (used, hits, _) in zip(parts, held):
                if len(used):
                    scores = hits.astype(np.float64) @ by_cell[used].astype(np.float64)
                    part += (TEXT_WEIGHT * scores).tolist()
            if len(blocks) > 1 and getattr(block, "_path", None):
                vars(block).pop("_value", None)  # read again when next asked for
        for part, (used, _, cells) in zip(parts, held):
            yield [*part, TEXT_WEIGHT * flat * cells] if len(used) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            out, held, size = [], [], 0
            for t in batch.column(0):
                body = t.as_py() or b""
                cells = trigram_cells(body)
                if not body or (cells == _BLANK).all():
                    held.append((nothing, nothing, 0))
                    continue
                hits = np.bincount(cells, minlength=CELLS)
                used = np.flatnonzero(hits)
                held.append((used, hits[used], len(cells)))
                size += len(used)
                if size > HELD:
                    out += score(held)
                    held, size = [], 0
            out += score(held)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(out, pa.list_(pa.float64()))],
                names=[*batch.schema.names[1:], "scores"])

    rows = docs.select(F.col(f"`{text}`").cast("string").cast("binary").alias("_body"),
                       *[F.col(f"`{c}`") for c in columns])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[1:])
    return rows.mapInArrow(run, f"{fields}, scores array<double>")


_BLANK = trigram_cells(b"   ")[0]


def page_evidence(pages: DataFrame) -> DataFrame:
    """``doc_id, declared, suffix, host``: what the pages of a document say about it, one row for
    each different statement.

    The document is the number that starts the last part of the page's path.
    """
    host = F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1))
    number = F.regexp_extract("url", r"://[^/?#]*(?:/[^/?#]*)*?/([0-9]{1,18})[^/?#]*/?(?:[?#]|$)", 1)
    rows = pages.select(
        F.when(number != "", number.cast("long")).alias("doc_id"),
        _some(F.lower(F.regexp_extract("html", MARKUP, 1))).alias("declared"),
        _some(F.regexp_extract(host, r"\.([^.]+)$", 1)).alias("suffix"), _some(host).alias("host"))
    return rows.where("doc_id is not null").distinct()


def _some(value: Column) -> Column:
    return F.when(value != "", value)


def _best(scores: Column, names: list[str]) -> Column:
    """Name of the largest score; the first of equals."""
    at = F.array_position(scores, F.array_max(scores)).cast("int")
    return F.when(F.size(scores) > 0, F.element_at(F.array(*[F.lit(n) for n in names]), at))


def _counts(rows: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """``by`` and ``counts``: rows by guess, in the order of ``names``."""
    pair = F.when(F.col("guess") != UNKNOWN, F.struct("guess", "n"))
    maps = (rows.groupBy(*by, "guess").agg(F.count(F.lit(1)).alias("n"))
            .groupBy(*by).agg(F.map_from_entries(F.collect_list(pair)).alias("m")))
    every = F.transform(_names(names), lambda x: F.coalesce(F.element_at("m", x), F.lit(0).cast("long")))
    return maps.select(*by, every.alias("counts"))


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _table(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """log P(column | language) by value, smoothed, from the text's own verdicts."""
    known = rows.where(F.col(column).isNotNull())
    counts = _counts(known, [column], names)
    values = known.agg(F.count_distinct(column)).scalar()
    totals = _counts(known, [], names).scalar()
    counts = counts.withColumn("values", values).withColumn("totals", totals)
    chance = F.zip_with("counts", "totals", lambda n, t: F.log(
        (n + 0.5) / (t + 0.5 * F.col("values"))))
    even = F.log(F.lit(1.0) / F.col("values"))
    return counts.select(column, F.concat(chance, F.array(even)).alias(f"by_{column}"))


def _shares(counts: Column, base: Column, strength: float) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n) + F.lit(strength)
    return F.zip_with(counts, base, lambda n, b: (n + b * F.lit(strength)) / total)


def _priors(rows: DataFrame, names: list[str]) -> DataFrame:
    """Prior of each language by host: counts shrunk to the suffix's, those to all rows'."""
    by_host = _counts(rows, ["host", "suffix"], names)
    by_suffix = _counts(rows, ["suffix"], names)
    even = F.array_repeat(F.lit(1.0 / len(names)), len(names))
    overall = _counts(rows, [], names).scalar()
    suffix = by_suffix.withColumn("_all", overall)
    suffix = suffix.withColumn("base", _shares(F.col("_all"), even, len(names)))
    suffix = suffix.select("suffix", _shares(F.col("counts"), F.col("base"), SUFFIX_STRENGTH).alias("base"))
    host = by_host.alias("h").join(suffix.alias("s"), F.col("h.suffix").eqNullSafe(F.col("s.suffix")))
    shares = _shares(F.col("counts"), F.col("base"), HOST_STRENGTH)
    logs = F.transform(shares, lambda c: F.log(c * F.lit(1 - UNKNOWN_PRIOR)))
    return host.select("host", F.col("h.suffix").alias("suffix"),
                       F.concat(logs, F.array(F.log(F.lit(UNKNOWN_PRIOR)))).alias("prior"))


def _told(evidence: DataFrame, tables: list[DataFrame], priors: DataFrame) -> DataFrame:
    """``doc_id, told, hosted``: what all statements about a document add to the log of each class.

    Factors of its different declarations and suffixes are added; of several hosts the mean of
    the logs is the prior. Sums are of whole numbers, so they come out alike in any order.
    """
    parts = [evidence.select("doc_id", name).distinct().join(by, name)
             .select("doc_id", F.lit(False).alias("of_host"), F.col(f"by_{name}").alias("logs"))
             for name, by in zip(("declared", "suffix"), tables)]
    hosts = evidence.where("host is not null").select("doc_id", "host", "suffix").distinct()
    hosts = hosts.join(priors, (hosts["host"] == priors["_host"])
                       & hosts["suffix"].eqNullSafe(priors["_suffix"]))
    parts.append(hosts.select("doc_id", F.lit(True).alias("of_host"), F.col("prior").alias("logs")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        "doc_id", "of_host", F.posexplode("logs").alias("at", "log"))
    fine = F.round(F.col("log") * FINE).cast("long")
    factors = F.coalesce(F.sum(F.when(~F.col("of_host"), fine)), F.lit(0))
    prior = F.sum(F.when(F.col("of_host"), fine)) / F.count_if("of_host")
    sums = rows.groupBy("doc_id", "at").agg(
        ((factors + F.coalesce(prior, F.lit(0.0))) / FINE).alias("log"),
        F.bool_or("of_host").alias("hosted"))
    return sums.groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "log"))), lambda x: x["log"])
        .alias("told"), F.bool_or("hosted").alias("hosted"))


def identify(docs: DataFrame, evidence: DataFrame, key: str = "doc_id", text: str = "text",
             label: str = "lang", fallback_host: str = "source", least: float = 0.35
             ) -> DataFrame:
    """``doc_id, mark, language, posterior, text_language, kept`` for every document.

    ``evidence`` (doc_id, declared, suffix, host) has any number of rows per document, each
    different one counts once; documents without a host are taken as hosted by
    ``fallback_host``. Texts are read where they lie.
    """
    names, fitted = fit(docs, text, label)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.xxhash64(F.col(f"`{text}`").cast("string")).alias("mark"),
                       F.col(f"`{fallback_host}`").cast("string").alias("place"),
                       F.col(f"`{text}`").alias("text"))
    scored = written(text_scores(rows, fitted, names, ["doc_id", "mark", "place"]), "langid-scores")
    if not names:
        nothing = F.lit(None).cast("string")
        return scored.select("doc_id", "mark", F.lit(UNKNOWN).alias("language"),
                             F.lit(0.0).alias("posterior"), nothing.alias("text_language"),
                             F.lit(False).alias("kept"))
    classes = [*names, UNKNOWN]
    scored = scored.withColumn("guess", _best(F.col("scores"), classes))
    evidence = written(evidence.select("doc_id", "declared", "suffix", "host").distinct(),
                       "langid-evidence")
    rows = written(scored.select("doc_id", "place", "guess").join(evidence, "doc_id", "left")
                   .select("declared", "suffix", F.coalesce("host", "place").alias("host"), "guess"),
                   "langid-rows")
    priors = _priors(rows, names).withColumnRenamed("host", "_host").withColumnRenamed(
        "suffix", "_suffix")
    by_document = _told(evidence, [_table(rows, c, names) for c in ("declared", "suffix")], priors)
    at_place = priors.where("_suffix is null").select("_host", "prior")
    told = (scored.join(by_document, "doc_id", "left")
            .join(at_place, F.col("place").eqNullSafe(F.col("_host")), "left"))
    none = F.array_repeat(F.lit(0.0), len(classes))
    fused = F.col("scores")
    for part in (F.coalesce("told", none),
                 F.when(F.coalesce("hosted", F.lit(False)), none).otherwise(F.coalesce("prior", none))):
        fused = F.zip_with(fused, part, lambda a, b: a + b)
    judged = told.withColumn("fused", F.when(F.size("scores") > 0, fused))
    top = F.array_max("fused")
    mass = F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("fused")))
    language = F.coalesce(_best(F.col("fused"), classes), F.lit(UNKNOWN))
    posterior = F.when(top.isNotNull(), 1 / mass).otherwise(0.0)
    judged = judged.select("doc_id", "mark", language.alias("language"),
                           posterior.alias("posterior"), F.col("guess").alias("text_language"))
    return judged.withColumn("kept", (F.col("language") != UNKNOWN) & (F.col("posterior") >= least))


def document_languages(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """``identify`` for a table of documents, with the evidence of the pages that show them."""
    return identify(docs, page_evidence(table(spark, sf_dir, "pages")))


def identified_documents(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """``docs`` without those rejected; ``lang`` keeps what it says."""
    number, mark = beside(docs, "_id", "_mark")
    rejected = (document_languages(spark, sf_dir, docs).where("not kept")
                .select(F.coalesce("doc_id", F.lit(-1)).alias(number), F.col("mark").alias(mark))
                .distinct())
    own = [F.col(f"`{c}`") for c in docs.columns]
    return (docs.select("*", F.xxhash64(F.col("text").cast("string")).alias(mark),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias(number))
            .join(rejected, [number, mark], "left_anti").select(*own))
