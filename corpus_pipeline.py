"""Corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Each stage reads what its predecessor kept and returns the columns of ``documents``; the
last returns one row per document with its shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetry.llm import decontaminate, jaccard, kdshards, mixing, quality_pu
from telemetry.llm.frames import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_pu.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at similarity 0.75 over five-word shingles."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark words."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts so that sources meet their target shares."""
    return mixing.replicate(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot."""
    return kdshards.shard_table(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix),
    ("sharding", shards),
]

#: The classifier is fitted, which SQL cannot express; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage{i}")
    return docs
