"""Streams of documents and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from webloom.streaming.segments import FANOUT, add_batch, live_postings


def read_document_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Crawled JSON documents as they are dropped below ``path``: ``(host, doc_id, url, text)``."""
    reader = spark.readStream.schema("url string, text string").option("multiLine", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.json(f"{path.rstrip('/')}/*/*.json").select("_metadata.file_path", "url", "text")
    return files.select(
        F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1).alias("host"),
        F.regexp_extract("file_path", r"([^/]+/[^/]+)$", 1).alias("doc_id"),
        "url",
        F.coalesce("text", F.lit("")).alias("text"),
    )


def index_stream(
    docs: DataFrame,
    index_path: str,
    checkpoint: str,
    stem: bool = False,
    fanout: int = FANOUT,
    **trigger,
) -> StreamingQuery:
    """Keep an index up to date with a stream of documents ``(doc_id, text[, removed][, version])``.

    Each micro-batch is a segment of its own, segments are merged by levels, and a manifest names
    those that count; see ``segments``. A batch that is run again after a failure leaves nothing of
    its first run.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, batch_id, index_path, stem, fanout)

    return (
        docs.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_streamed_postings(
    spark: SparkSession, index_path: str, doc_type: str = "bigint"
) -> DataFrame:
    """The postings ``(term, doc_id)`` that count now; an empty table before the first batch."""
    return live_postings(spark, index_path, doc_type)


def unseen_urls(links: DataFrame, event_time: str | None = None, within: str | None = None) -> DataFrame:
    """Drop addresses a link stream has delivered before.

    Without ``event_time`` every address is remembered for good, as a 128-bit digest; started by
    ``deliver_unseen``, that state lies on disk and not in the heap. With it, state is dropped once
    an address is older than ``within``, which bounds the state of an endless stream; there is no
    default for it, as an address that comes again later is delivered again.
    """
    if (event_time is None) != (within is None):
        raise ValueError("event_time and within go together")
    if event_time is None:
        # Null addresses are one address, as in a table without repeats.
        digest = F.unhex(F.md5(F.coalesce(F.concat(F.lit("u"), "url"), F.lit(""))))
        return links.withColumn("_digest", digest).dropDuplicates(["_digest"]).drop("_digest")
    return links.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["url"])


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def deliver_unseen(links: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write the addresses of a link stream, each once for all time, as Parquet below ``path``.

    The digests of what was delivered lie in RocksDB: on the executors' disks, with a log of changes
    in ``checkpoint``, from which a restarted query goes on. A query keeps the state store that the
    session names when it starts; the setting is put back at once.
    """
    own = links.sparkSession
    before = own.conf.get(STATE_STORE, None)
    own.conf.set(STATE_STORE, ROCKSDB)
    try:
        writer = unseen_urls(links).writeStream.format("parquet").option("path", path)
        writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
        return writer.start()
    finally:
        own.conf.set(STATE_STORE, before) if before else own.conf.unset(STATE_STORE)
