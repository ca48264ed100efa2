"""A corpus pipeline of five operators; each stage reads what the one before it wrote.

The stages filter or rewrite ``documents`` rows and keep their columns; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import line_dedup, packing, quality, substring, widehash
from linkloom.llm._stash import named, stash
from linkloom.llm.queries import table, word_vocabulary


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of texts, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without boilerplate lines; texts that occur more than once and are mostly such lines are left to the next stage."""
    return _sized(line_dedup.remove_boilerplate(docs, spare_repeated=0.5).select(*map(named, docs.columns)))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies: five-word shingles, similarity 0.8 or more.

    64-bit fingerprints differ by about ten bits at that similarity, beyond what op3's index reaches, so candidates
    come from the tables of 512-bit SimHash fingerprints and are checked exactly.
    """
    return widehash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one has."""
    return _sized(substring.remove_repeats(docs, output="text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences; few words are remembered, as workers and executors still hold memory of the stages before."""
    return packing.pack_documents(docs, word_vocabulary(), words=150_000)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]

#: Near-duplicate classes, learned weights and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
