"""File sources: text, JSON, Word and gzipped JSON lines, one document table for all."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.sources.gzip_members import RANGE_BYTES, read_gzip_lines

DOCUMENT_SCHEMA = "url string, text string"
ITEM_SCHEMA = "asin string, category array<string>, description array<string>, price string"
REVIEW_SCHEMA = "reviewerID string, asin string, overall double"

# Namespace of WordprocessingML (fixed value).
WORD_NAMESPACE = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def read_text_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole UTF-8 files: ``(path, text)``."""
    return _reader(spark, glob).text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def read_json_files(
    spark: SparkSession, path: str, schema: str = DOCUMENT_SCHEMA, glob: str | None = None
) -> DataFrame:
    """Whole JSON files with an explicit schema: ``(path, <fields>)``."""
    reader = _reader(spark, glob).schema(schema).option("multiLine", True)
    return reader.json(path).select(F.col("_metadata.file_path").alias("path"), "*")


def read_word_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Word files: ``(path, text)`` with paragraph texts joined by one space."""
    files = _reader(spark, glob).format("binaryFile").load(path)
    return files.select("path", "content").mapInPandas(_word_texts, "path string, text string")


def _word_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "text": batch["content"].map(_word_text)})


def _word_text(content: bytes) -> str | None:
    """Text of a Word file; null for bytes that are none, so one bad file does not end the job."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            body = ElementTree.fromstring(archive.read("word/document.xml"))[0]
    except (zipfile.BadZipFile, KeyError, IndexError, ElementTree.ParseError):
        return None
    marks = {WORD_NAMESPACE + "tab": "\t", WORD_NAMESPACE + "br": "\n", WORD_NAMESPACE + "cr": "\n"}
    paragraphs = []
    for paragraph in body.findall(WORD_NAMESPACE + "p"):
        runs = [node for run in paragraph.iter(WORD_NAMESPACE + "r") for node in run]
        text = [n.text or "" if n.tag == WORD_NAMESPACE + "t" else marks.get(n.tag, "") for n in runs]
        paragraphs.append("".join(text))
    return " ".join(paragraphs)


def load_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents by file extension, in any letter case, and the files that could not be read.

    Returns ``(path, text)`` of ``.txt``, ``.json`` and ``.docx`` files, and a quarantine table
    ``(path, reason)``. A path that matches nothing is an error raised by the reader.
    """
    listing = spark.read.format("binaryFile").load(path).select("path")
    extension = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    text = read_text_files(spark, path, "*.[tT][xX][tT]")
    marked = f"{DOCUMENT_SCHEMA}, _corrupt_record string"
    parsed = read_json_files(spark, path, marked, glob="*.[jJ][sS][oO][nN]")
    json = parsed.where(F.col("_corrupt_record").isNull()).select("path", "text")
    word = read_word_files(spark, path, "*.[dD][oO][cC][xX]")
    documents = text.unionByName(json).unionByName(word.where(F.col("text").isNotNull()))
    unsupported = listing.where(~extension.isin("txt", "json", "docx")).select(
        "path", F.concat(F.lit("unsupported file type: "), extension).alias("reason")
    )
    broken = word.where(F.col("text").isNull()).select(
        "path", F.lit("not a Word file").alias("reason")
    )
    malformed = parsed.where(F.col("_corrupt_record").isNotNull()).select(
        "path",
        F.when(F.col("text").isNull(), "malformed JSON").otherwise("partly malformed JSON").alias("reason"),
    )
    return documents, unsupported.unionByName(broken).unionByName(malformed)


def corpus_scan(spark: SparkSession, base: str) -> DataFrame:
    """Crawled documents ``(host, doc_id, url, text)`` one directory level below ``base``.

    The host is the directory, ``doc_id`` the file name; a missing text is empty.
    """
    files = read_json_files(spark, f"{base.rstrip('/')}/*/*.json")
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return files.select(
        F.regexp_replace(folder, "^host=", "").alias("host"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("doc_id"),
        "url",
        F.coalesce("text", F.lit("")).alias("text"),
    )


def read_json_lines(
    spark: SparkSession, path: str, schema: str, partitions: int | None = None, rows: int | None = None
) -> DataFrame:
    """JSON lines, plain or gzipped, with an explicit schema.

    A gzip file is read by one task, so its rows are spread over ``partitions`` right away.
    ``rows`` keeps the first so many, by file name and place in the file.
    """
    lines = spark.read.schema(schema).json(path)
    if rows is not None:
        place = ["_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()]
        lines = lines.orderBy(*place).limit(rows).select(*lines.columns)
    return lines.repartition(partitions) if partitions else lines


def read_json_members(
    spark: SparkSession, path: str, schema: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """JSON lines of gzip files of many members, each file read by several tasks.

    For folders that ``pyarrow.fs`` opens; ``read_json_lines`` reads whatever Spark reads. Empty
    lines are passed over; a line that is no JSON gives nulls.
    """
    lines = read_gzip_lines(spark, path, range_bytes).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("row")).select("row.*")


def read_reviews(spark: SparkSession, path: str, rows: int | None = None, **options) -> DataFrame:
    return read_json_lines(spark, path, REVIEW_SCHEMA, rows=rows, **options)


def read_items(spark: SparkSession, path: str, rows: int | None = None, **options) -> DataFrame:
    return read_json_lines(spark, path, ITEM_SCHEMA, rows=rows, **options)


def read_robots(spark: SparkSession, path: str) -> DataFrame:
    """Robots files ``(host, robots_txt)``; the host is the file name up to ``_robots.txt`` or
    ``.txt``."""
    name = F.regexp_extract("path", r"([^/]+?)(?:_robots)?\.txt$", 1)
    return read_text_files(spark, path).select(
        name.alias("host"), F.col("text").alias("robots_txt")
    )


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("word"))


def _reader(spark: SparkSession, glob: str | None):
    return spark.read.option("pathGlobFilter", glob) if glob else spark.read
