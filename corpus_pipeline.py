"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes what the one before it kept, as a table written in the shared folder. All but
the last return the columns of documents; packing returns one row for each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidar.llm.common import bounded, table, written
from evidar.llm.exact_dedup import dedup_stage
from evidar.llm.language_id import language_stage
from evidar.llm.mixing import mixing_stage
from evidar.llm.packing import packing_stage
from evidar.llm.similar import near_dedup_stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any language go: those without a letter."""
    bounded(spark)
    return language_stage(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return dedup_stage(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8) stays, the one of least id."""
    bounded(spark)
    return near_dedup_stage(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    bounded(spark)
    return mixing_stage(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return packing_stage(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, rounding and packing have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
