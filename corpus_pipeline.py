"""Corpus pipeline over ``documents``: language, near-duplicates, benchmark passages, mixture, shards.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` whose rows are written as Parquet to the
shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.llm import decontam, forest_join, langid, mixing, shards
from webloom.llm.common import shared_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found (operator 8); texts without a letter, and null ones, go."""
    return langid.with_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of documents that hang together by similarity (operator 2)."""
    return forest_join.first_of_each_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark (operator 7)."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as their domain's rate admits them (operator 9): junk and toxic ones are thinned to
    their target share of the tokens, clean ones stay."""
    return mixing.mixed_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of each document (operator 3)."""
    return shards.shard_table(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_domains),
    ("sharding", cut_shards),
]

# The learnt stages have no SQL; tests compare the rest with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what its predecessor kept."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
