"""From raw documents to packed sequences: five stages over the table ``documents``.

Each stage takes all that the one before kept and returns the columns of ``documents``; the last
returns the packing. ``run`` writes every stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.llm import langid, mixing, packing, pii, simhash
from headway.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that text, markup, address and host agree on."""
    return langid.identified_documents(spark, sf_dir, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose fingerprints of 3-word shingles differ in two bits
    or less, that of the smallest id."""
    return simhash.one_per_group(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and lengths counted again."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; whole epochs and a seeded rest."""
    return mixing.mixed_documents(docs, key=["doc_id"])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and position."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("mask_personal_data", mask_personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Fingerprints, trained likelihoods and best-fit placement have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
