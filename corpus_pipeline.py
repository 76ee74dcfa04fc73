"""The corpus pipeline: five stages, each written as Parquet and read again.

quality rules -> MinHash near-dedup -> suffix-array dedup -> benchmark
decontamination -> best-fit packing. All stages but the last return the columns
of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, near_dedup, packing, quality_rules, suffix_dedup
from tidemark.llm.frames import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    rules = quality_rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, rules)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_first(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte runs that an earlier one holds."""
    return suffix_dedup.without_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, added=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# The stages learn, link by minimum hashes, sort suffixes, search an index and fit
# patterns: SQL expresses none of them whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
