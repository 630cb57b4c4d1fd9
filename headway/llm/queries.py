"""The registered queries of the subpackage and the SQL some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm import (chat, jaccard, langid, mixing, negatives, packing, periodic, pii, quality, repeats,
                         simhash, topk, urls)
from headway.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, with its source's size and target."""
    docs = table(spark, sf_dir, "documents")
    targets, taken = mixing.mix(docs.select("doc_id", "text", "source"), key=["doc_id"])
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return (taken.join(targets, F.col("source").eqNullSafe(F.col("_source")))
            .select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                    (F.col("_size") * F.col("_repeats")).alias("taken")))


def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without its long repeated byte strings."""
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and whether the rules' joint verdict keeps it."""
    found = quality.judge(table(spark, sf_dir, "documents"))
    return found.withColumn("posterior", F.round("posterior", 6))


def op4_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from every participant's side, with its mask."""
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = urls.page_outcomes(pages, table(spark, sf_dir, "labels"))
    return urls.judge(pages, outcomes).drop("bound")


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    text = F.lpad(F.lower(F.hex("print")), 16, "0")
    return near.select("doc_id", text.alias("fingerprint"), "component_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, its posterior, and whether the document stays."""
    found = langid.document_languages(spark, sf_dir, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "language", F.round("posterior", 6).alias("posterior"),
                        "text_language", "kept")


def op9_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and position of every piece of every document."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the strongest of them, and a digest of the text without repeats."""
    docs = periodic.with_planted_runs(table(spark, sf_dir, "documents"))
    found = periodic.periodic_runs(docs).withColumn("best", periodic.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of shingles and component of every document."""
    return jaccard.resembling(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector, after a seventh of the labels has been moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_repeated_bytes, op3_weak_supervision, op4_chat_perspectives,
        op5_threshold_topk, op6_simhash_groups, op7_host_reputation, op8_language_id,
        op9_pii_spans, op10_best_fit_packing, op11_periodic_runs, op12_jaccard_groups,
        op13_hard_negatives)
}
SQL: dict[str, str] = {
    "op4_chat_perspectives": chat.check_sql(),
    "op5_threshold_topk": topk.check_sql(20),
    "op7_host_reputation": urls.check_sql(),
    "op12_jaccard_groups": jaccard.check_sql(),
    "op13_hard_negatives": negatives.check_sql(),
}
