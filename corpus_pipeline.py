"""A training corpus from raw documents: five stages, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartlake.llm import decontaminate, pieces, simhash, suffix_dedup, toxicity
from cartlake.llm.common import settle, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the ordinal regression rejects; the model is learned from the labelled ones."""
    return toxicity.deny(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return simhash.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that start more than once in what is left."""
    return suffix_dedup.cleaned(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words, or all words, of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return pieces.encoded(docs, pieces.model_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("decontaminate", drop_benchmark_leaks),
    ("sentencepiece", encode),
]

#: SQL has no word for most stages; the tests hold each of them against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
