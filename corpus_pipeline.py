"""A training corpus from raw documents: language, near duplicates, benchmark leaks, mixture, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.common import table, written
from skyledger.llm.langid import known_language
from skyledger.llm.mixing import by_length, mixed_documents
from skyledger.llm.nearcopies import one_of_near_copies
from skyledger.llm.placement import place
from skyledger.llm.queries import SHARDS
from skyledger.llm.tiling import decontaminated


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language. The network learns from the labelled rows of what it is given."""
    return known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard similarity 0.8): that of the smallest id."""
    return one_of_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs, preference=by_length())


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the slot and the shard it goes to."""
    return place(docs, SHARDS)


STAGES = [("language ID", language), ("near-dedup", near_dedup), ("decontamination", decontaminate), ("mixture", mixture), ("sharding", sharding)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
