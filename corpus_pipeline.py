"""From raw documents to training shards: five stages over the operators of ``salesmart.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each as Parquet below the shared folder and reads it back as the next
one's input, so a lost executor costs at most a stage's own work. All stages
but the last return the columns of ``documents``. Every stage accepts null
columns, repeated rows, empty texts and empty tables: see its operator.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from salesmart.llm import decontaminate, langid, mixing, near_copies, sharding  # noqa: E402
from salesmart.llm.common import Scratch, table  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: null texts, texts without a letter, and texts like no mixture of learned languages."""
    return langid.keep_identified(docs, langid.train(docs), likely=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the least doc_id, of what five-word Jaccard similarities of 0.8 or more connect.

    SimHash classes of the vantage-point trees are compared first, min-hash bands after them; both verify exactly.
    """
    return near_copies.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item within its error budget."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source to its target, repeating or leaving documents, each copy where its epoch is due."""
    return mixing.scheduled_copies(docs)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each row; equal texts share one."""
    return sharding.shard_rows(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
    ("sharding", shard_documents),
]

# Fingerprints, language mixtures and edit distances are outside SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; earlier stages' tables are deleted once read."""
    scratch = Scratch(spark, "pipeline")
    docs, previous = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if previous is not None:
            scratch.drop(previous)
        previous = docs
    return docs
