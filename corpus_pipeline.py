"""From raw documents to packed training windows, stage by stage.

Every stage works on all that its predecessor kept, as written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormledger.llm import decontamination, jaccard, packing, pii, quality_rules
from stormledger.llm.common import table
from stormledger.llm.queries import TOKENIZER
from stormledger.storage import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: 5-word shingles, similarity 0.8 or more."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, are replaced in the texts."""
    return pii.sanitise(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in windows of one length."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", privacy_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # the last stage needs a tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that come through the stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
