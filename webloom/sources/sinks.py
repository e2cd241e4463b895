"""Sinks: crawled documents, index tables and the gate between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators.index import postings_blocks


class EmptyStageError(RuntimeError):
    """A stage produced nothing for the next one to work on."""


def require_rows(df: DataFrame, stage: str) -> DataFrame:
    """Pass ``df`` on if it has any row; looks at one row only."""
    if df.isEmpty():
        raise EmptyStageError(f"stage {stage!r} produced no rows")
    return df


def write_documents(docs: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Append crawled documents ``(host, ...)`` as JSON lines, one directory for each host. Rows are
    laid out by host and id first, so a task opens files of few hosts and a large host has several."""
    keys = [c for c in ("host", "doc_id") if c in docs.columns]
    writer = docs.repartitionByRange(*keys).write.mode("append").partitionBy("host")
    writer.option("maxRecordsPerFile", rows_per_file).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    schema = "doc_id string, url string, text string, host string"
    docs = spark.read.schema(schema).json(path)
    return docs.select("host", "doc_id", "url", F.coalesce("text", F.lit("")).alias("text"))


def write_index(postings: DataFrame, dictionary: DataFrame, path: str) -> None:
    """Write the index as parquet: postings in term, document order and the term dictionary.

    Files cover value ranges of both columns, so a look-up of a few terms skips the other files
    and a frequent term spreads over many.
    """
    ordered = postings.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")
    ordered.write.mode("overwrite").parquet(f"{path}/postings")
    dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/dictionary")


def export_index(postings: DataFrame, path: str, span: int = 65536) -> None:
    """Export postings as JSON lines ``{term, block, doc_ids}``; see ``postings_blocks``."""
    postings_blocks(postings, span).write.mode("overwrite").json(path)


def export_frequency(dictionary: DataFrame, path: str) -> None:
    """Export document frequencies as JSON lines ``{term, df}``."""
    dictionary.select("term", "df").write.mode("overwrite").json(path)


def read_exported_index(spark: SparkSession, path: str) -> DataFrame:
    """Long postings from the exported blocks."""
    blocks = spark.read.schema("term string, block bigint, doc_ids array<bigint>").json(path)
    return blocks.select("term", F.explode("doc_ids").alias("doc_id"))
