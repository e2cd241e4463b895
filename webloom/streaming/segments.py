"""Index of a changing document stream: segments, a manifest of those that count, levelled merging.

Every micro-batch becomes a segment: the postings of its documents and a mark for each of them. A
posting counts if no later segment marks its document, so a changed text replaces the old one and a
mark alone removes it. ``FANOUT`` segments of one level are merged into one of the next, without
what no longer counts; n batches leave O(log n) segments. The manifest is a small table of the
segments, one version for each batch; what no version names does not exist for readers.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators.index import term_postings

FANOUT = 4
MANIFEST_SCHEMA = "name string, level int, first_batch bigint, last_batch bigint, version bigint"


class Segment(NamedTuple):
    name: str
    level: int
    first_batch: int
    last_batch: int


def read_manifest(spark: SparkSession, path: str) -> dict[int, list[Segment]]:
    """The segments of the versions that are kept, oldest first. Each list is logarithmic in the
    number of batches."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    versions: dict[int, list[Segment]] = {}
    for row in sorted(rows, key=lambda r: (r["version"], r["first_batch"])):
        versions.setdefault(row["version"], []).append(Segment(*row[:4]))
    return versions


def write_manifest(spark: SparkSession, path: str, version: int, segments: list[Segment]) -> None:
    """One file, which appears when the job commits: the batch counts from then on."""
    rows = spark.createDataFrame([tuple(s) for s in segments], MANIFEST_SCHEMA.rsplit(",", 1)[0])
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")


def _tables(spark: SparkSession, path: str, segments: list[Segment], doc_type: str) -> tuple[DataFrame, DataFrame]:
    """``postings (term, doc_id, batch)`` and ``marks (doc_id, batch, removed)`` of some segments."""
    folders = [f"{path}/segments/{s.name}" for s in segments]
    postings = spark.read.schema(f"term string, doc_id {doc_type}, batch bigint")
    marks = spark.read.schema(f"doc_id {doc_type}, batch bigint, removed boolean")
    return postings.parquet(*[f"{f}/postings" for f in folders]), marks.parquet(*[f"{f}/marks" for f in folders])


def _live(postings: DataFrame, marks: DataFrame) -> DataFrame:
    """Postings that no later mark voids. Only documents with several marks are joined."""
    several = marks.groupBy("doc_id").agg(F.max("batch").alias("newest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = postings.join(several.select("doc_id", "newest"), "doc_id", "left")
    return joined.where(F.col("newest").isNull() | (F.col("batch") == F.col("newest"))).drop("newest")


def _write_segment(path: str, name: str, postings: DataFrame, marks: DataFrame) -> None:
    laid = postings.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")
    laid.select("term", "doc_id", "batch").write.mode("overwrite").parquet(f"{path}/segments/{name}/postings")
    marks.select("doc_id", "batch", "removed").write.mode("overwrite").parquet(f"{path}/segments/{name}/marks")


def merge_segments(
    spark: SparkSession, path: str, segments: list[Segment], doc_type: str, oldest: bool
) -> Segment:
    """One segment in place of neighbouring ones of one level. With the ``oldest`` among them, marks
    of removed documents have nothing left to void and go."""
    postings, marks = _tables(spark, path, segments, doc_type)
    newest = marks.groupBy("doc_id").agg(F.max(F.struct("batch", "removed")).alias("m")).select("doc_id", "m.*")
    if oldest:
        newest = newest.where(~F.col("removed"))
    first, last = segments[0].first_batch, segments[-1].last_batch
    made = Segment(f"level{segments[0].level + 1}-{first}-{last}", segments[0].level + 1, first, last)
    _write_segment(path, made.name, _live(postings, marks), newest)
    return made


def _merged(spark: SparkSession, path: str, segments: list[Segment], doc_type: str, fanout: int) -> list[Segment]:
    while True:
        levels: dict[int, list[Segment]] = {}
        for s in segments:
            levels.setdefault(s.level, []).append(s)
        full = [group for level, group in sorted(levels.items()) if len(group) >= fanout]
        if not full:
            return segments
        group = full[0]
        made = merge_segments(spark, path, group, doc_type, oldest=group[0] == segments[0])
        rest = [s for s in segments if s not in group]
        segments = sorted([*rest, made], key=lambda s: s.first_batch)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def add_batch(
    batch: DataFrame, batch_id: int, path: str, stem: bool = False, fanout: int = FANOUT
) -> None:
    """Put a micro-batch ``(doc_id, text[, removed][, version])`` into the index at ``path``.

    Of several rows of a document that with the greatest version counts, then a removal, then the
    greatest text. A batch that the manifest has is left alone; one that failed before that starts
    anew and overwrites its files. Readers of the version before keep their segments until the next
    batch.
    """
    spark = batch.sparkSession
    doc_type = batch.schema["doc_id"].dataType.simpleString()
    versions = read_manifest(spark, path)
    newest = max(versions, default=-1)
    segments = versions.get(newest, [])
    if segments and segments[-1].last_batch >= batch_id:
        return
    removed = F.coalesce(F.col("removed"), F.lit(False)) if "removed" in batch.columns else F.lit(False)
    order = ([F.col("version").alias("version")] if "version" in batch.columns else []) + [removed.alias("removed"), "text"]
    docs = batch.groupBy("doc_id").agg(F.max(F.struct(*order)).alias("d")).select("doc_id", "d.text", "d.removed")
    stamped = lambda df: df.withColumn("batch", F.lit(batch_id).cast("bigint"))
    name = f"batch-{batch_id}"
    there = docs.where(~F.col("removed") & F.col("doc_id").isNotNull())
    _write_segment(path, name, stamped(term_postings(there, stem)), stamped(docs.where(F.col("doc_id").isNotNull())))
    after = _merged(spark, path, [*segments, Segment(name, 0, batch_id, batch_id)], doc_type, fanout)
    write_manifest(spark, path, newest + 1, after)
    for version in sorted(versions)[:-1]:
        _delete(spark, f"{path}/manifest/version={version}")
        for segment in versions[version]:
            if segment not in segments:
                _delete(spark, f"{path}/segments/{segment.name}")


def live_postings(spark: SparkSession, path: str, doc_type: str = "bigint") -> DataFrame:
    """``(term, doc_id)`` of all documents as they are now; none before the first batch."""
    versions = read_manifest(spark, path)
    if not versions:
        return spark.createDataFrame([], f"term string, doc_id {doc_type}")
    postings, marks = _tables(spark, path, versions[max(versions)], doc_type)
    return _live(postings, marks).select("term", "doc_id")
