"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that its predecessor kept, written as Parquet and
read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import language, mixing, near_dedup, packing, privacy
from shelfwise.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; null texts, texts without letters and what no model accepts go."""
    return language.accepted(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dedup.deduplicated(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it generalised."""
    return privacy.sanitised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights, as documents."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes: sequence and offset."""
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup_stage),
    ("personal_data", remove_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# No stage can be stated in SQL: models, hashes, patterns with positions, draws and packing plans.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
