"""Balanced contiguous shards by global prefix sums of byte sizes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import shared_table

SHARDS = 24
# Bytes that a document takes besides its text.
OVERHEAD = 8


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32)``. A null text has no bytes and the checksum of none, 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``: documents in the order of their ids, cut into
    ``shards`` contiguous runs of equal bytes.

    The rows, without texts, are cut into ranges of the order and written once, so that every later
    read sees the same ranges. Each range has its total; the sums before it, over one row for each
    range, turn sums within a range into global ones. A document goes to the shard in which the
    middle of its bytes lies, so a shard's bytes differ from the target by less than the documents
    at its two ends. Null ids come first; rows with one id stand next to each other, ordered by size
    and checksum, and rows alike in all three are interchangeable. No rows give no rows.
    """
    order = ["doc_id", "size", "text_crc32"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = sized(docs).repartitionByRange(parts, *order)
    kept = shared_table(ranges.withColumn("_range", F.spark_partition_id()))

    totals = kept.groupBy("_range").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    # One row for each range, whatever the number of documents.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    starts = totals.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row"),
        F.sum("_bytes").over(whole).alias("_all"),
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = kept.select(
        "*",
        (F.sum("size").over(upto) - F.col("size")).alias("_in"),
        F.row_number().over(inside).alias("_nth"),
    ).join(F.broadcast(starts), "_range")  # as many rows as there are ranges
    # The middle of the document over all bytes, in integers.
    shard = F.expr(f"((2 * (_byte + _in) + size) * {int(shards)}) div (2 * _all)")
    numbered = shared_table(
        placed.select(
            *order,
            F.least(shard, F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("_row") + F.col("_nth")).cast("bigint").alias("_place"),
        )
    )
    first = numbered.groupBy("shard").agg(F.min("_place").alias("_first"))
    return numbered.join(F.broadcast(first), "shard").select(  # one row for each shard
        *order, "shard", (F.col("_place") - F.col("_first")).alias("slot")
    )


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The assignment with the law it follows; ``grown_shard`` belongs to another law and is null."""
    return assign_shards(docs, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_texts(docs: DataFrame, assignment: DataFrame) -> DataFrame:
    """The documents with their shard and slot, for ids that are unique. Columns of the same names
    that the documents bring along give way."""
    mine = docs.drop("shard", "slot")
    return mine.join(assignment.select("doc_id", "shard", "slot"), "doc_id")


def write_shards(docs: DataFrame, assignment: DataFrame, path: str) -> None:
    """One folder for each shard, rows in the order of their slots. Each file is a run of slots, so
    a shard of any size is written by many tasks."""
    rows = with_texts(docs, assignment)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot")
    laid.write.partitionBy("shard").parquet(path)
