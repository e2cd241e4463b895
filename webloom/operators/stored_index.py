"""A stored inverted index of sorted blocks with a directory, searched without reading other blocks.

``blocks`` holds ``(term, block, doc_ids)``, runs of at most ``BLOCK_IDS`` ascending document ids; the
``directory`` holds ``(term, block, first_id, last_id, n, df, blocks, top_id)`` for each of them and no ids. Both
are partitioned by a hash of the term, so a search opens the partitions of its terms only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.operators.index import short_list
from webloom.operators.skew import numbered
from webloom.session import cut_lineage, cut_lineage_in_place

BLOCK_IDS = 1024
# Document ids that one list of a term's ids can span before blocks are cut.
SPAN = 65_536
# Rows of one term, a list each, that one window may hold.
MANY_PARTS = 100_000
# Below the part of any 64-bit id.
BEFORE_ALL = -(1 << 62)
# Partitions of both tables.
BUCKETS = 64
BLOCK_SCHEMA = "term string, block bigint, doc_ids array<bigint>, bucket int"
DIRECTORY_SCHEMA = (
    "term string, block bigint, first_id bigint, last_id bigint, n int, df bigint, blocks bigint, top_id bigint, bucket int"
)


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def posting_blocks(postings: DataFrame, block_ids: int = BLOCK_IDS, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, term, block, first_id, last_id, n, df, blocks, top_id, doc_ids)`` from distinct postings
    ``(term, doc_id)`` with integer ids, in ranges of bucket, term and block.

    Ids move as lists of one term and at most ``SPAN`` ids, which are cut where blocks end. The places of
    the lists in their terms come from the lists' lengths alone.
    """
    # Null ids take their places before all others, and are in no list.
    part = F.coalesce(F.floor(F.col("doc_id") / F.lit(SPAN)), F.lit(BEFORE_ALL))
    lists = cut_lineage_in_place(
        postings.withColumn("part", part)
        .groupBy("term", "part")
        .agg(F.sort_array(F.collect_list("doc_id")).alias("ids"), F.count(F.lit(1)).alias("places"))
    )
    placed = lists.join(_places(lists), ["term", "part"])
    start, size = F.col("end") - F.col("places"), F.lit(block_ids)

    def piece(block: Column) -> Column:
        first, last = F.greatest(block * size, start), F.least((block + 1) * size, F.col("end"))
        ids = F.slice("ids", (first - start + 1).cast("int"), (last - first).cast("int"))
        return F.struct(block.alias("block"), ids.alias("ids"))

    spanned = F.sequence(F.floor(start / size), F.floor((F.col("end") - 1) / size))
    blocks = F.ceil(F.col("all_places") / size).alias("blocks")
    pieces = placed.select("term", "df", blocks, "top_id", F.inline_outer(F.transform(spanned, piece)))
    # A range holds whole blocks, so the pieces of a block meet without another shuffle.
    key = ["bucket", "term", "block"]
    laid = pieces.withColumn("bucket", _bucket(F.col("term"), buckets)).repartitionByRange(*key)
    runs = laid.groupBy(*key, "df", "blocks", "top_id").agg(
        F.sort_array(F.flatten(F.collect_list("ids"))).alias("doc_ids")
    )
    ends = [F.col("doc_ids")[0].alias("first_id"), F.element_at("doc_ids", -1).alias("last_id")]
    return runs.select(*key, *ends, F.size("doc_ids").alias("n"), "df", "blocks", "top_id", "doc_ids")


def _places(lists: DataFrame) -> DataFrame:
    """``(term, part, end, df, all_places, top_id)``: the last place of each list in its term and the totals
    of the term. A term has at most a list for each part; with very many parts, as ids far apart have,
    places are numbered over sampled ranges, so no task holds a frequent term."""
    top = F.array_max("ids").alias("top")
    sizes = lists.select("term", "part", "places", F.size("ids").alias("held"), top)
    totals = sizes.groupBy("term").agg(
        F.sum("held").alias("df"), F.sum("places").alias("all_places"), F.max("top").alias("top_id")
    )
    slim = sizes.select("term", "part", "places")
    if lists.select("part").distinct().count() <= MANY_PARTS:
        ends = slim.withColumn("end", F.sum("places").over(Window.partitionBy("term").orderBy("part")))
    else:
        ends = numbered(slim, ["part"], "end", group=["term"], weight="places")
    return ends.select("term", "part", "end").join(totals, "term")


def write_stored_index(
    postings: DataFrame, path: str, block_ids: int = BLOCK_IDS, buckets: int = BUCKETS
) -> None:
    """Write blocks and directory below ``path``. Files of a partition cover ranges of terms."""
    made = cut_lineage(posting_blocks(postings, block_ids, buckets))
    ids = F.col("doc_ids").cast("array<bigint>").alias("doc_ids")
    _write(made.select("bucket", "term", "block", ids), f"{path}/blocks")
    ends = [F.col(c).cast("bigint").alias(c) for c in ("first_id", "last_id")]
    top = F.col("top_id").cast("bigint").alias("top_id")
    _write(made.select("bucket", "term", "block", *ends, "n", "df", "blocks", top), f"{path}/directory")


def _write(table: DataFrame, path: str) -> None:
    rows = table.sortWithinPartitions("bucket", "term", "block")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_stored_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(blocks, directory)``."""
    return (
        spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks"),
        spark.read.schema(DIRECTORY_SCHEMA).parquet(f"{path}/directory"),
    )


def _cell(doc_id: Column) -> Column:
    """Which of as many equal spans of ids as the term has blocks an id falls into. A frequent term has
    narrow spans, so that a span meets few of its blocks however the ids are spread."""
    span = F.greatest(F.floor((F.col("top_id") + F.col("blocks")) / F.col("blocks")), F.lit(1))
    return F.floor(doc_id / span)


def search_plan(terms: DataFrame, directory: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """``(asked, located)``: the queries ``(query_id, term, df, rarest)`` all of whose terms are in the
    index, and the directory of the asked terms with the ``cell`` of ids that each entry covers."""
    wanted = terms.select("query_id", "term").distinct().withColumn("bucket", _bucket(F.col("term"), buckets))
    # As long as the batch of searches has terms.
    listed, _ = short_list(wanted.select("bucket", "term").distinct())
    known = cut_lineage(directory.join(listed, ["bucket", "term"], "left_semi"))
    frequency = known.where("block = 0").select("term", "df")
    # The terms of a query come from one text, which bounds the windows.
    each = Window.partitionBy("query_id")
    asked = (
        wanted.join(frequency, "term", "left")
        .withColumn("_all", F.count(F.lit(1)).over(each) == F.count("df").over(each))
        .withColumn("_first", F.row_number().over(each.orderBy("df", "term")))
        .where("_all")
        .select("query_id", "term", "df", (F.col("_first") == 1).alias("rarest"))
    )
    cells = F.sequence(_cell(F.col("first_id")), _cell(F.col("last_id")))
    return asked, known.withColumn("cell", F.explode_outer(cells))


def search_stored(
    terms: DataFrame, blocks: DataFrame, directory: DataFrame, buckets: int = BUCKETS
) -> DataFrame:
    """Documents that hold all terms of a query: ``(query_id, doc_id)`` for ``terms (query_id, term)``.

    The blocks of each query's rarest term are read whole: their ids are the candidates. The
    directory says in which block of another term a candidate can stand; only those blocks are read
    and intersected with the candidates that fall into them. A query with an unknown term finds
    nothing.
    """
    return _searched(terms, blocks, directory, buckets)[0]


def _searched(
    terms: DataFrame, blocks: DataFrame, directory: DataFrame, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """The hits, and the blocks ``(bucket, term, block)`` that are read for them."""
    asked, located = search_plan(terms, directory, buckets)
    asked, located = cut_lineage(asked), cut_lineage(located)
    start = asked.where("rarest").select("query_id", "term")
    seeds = located.select("bucket", "term", "block").distinct().join(
        start.select("term").distinct(), "term", "left_semi"
    )
    key = ["bucket", "term", "block"]
    rarest, _ = short_list(seeds.select("bucket", "term").distinct())
    first = blocks.join(rarest, ["bucket", "term"], "left_semi").select("term", F.explode("doc_ids").alias("doc_id"))
    candidates = cut_lineage(first.join(start, "term").select("query_id", "doc_id"))
    others = asked.where(~F.col("rarest")).select("query_id", "term")
    spans = located.select("term", "top_id", "blocks").distinct()
    # One row for each candidate and other term, placed by the span of ids that it falls into.
    probes = candidates.join(others.join(spans, "term"), "query_id").withColumn("cell", _cell(F.col("doc_id")))
    inside = F.col("doc_id").between(F.col("first_id"), F.col("last_id"))
    entries = located.select("bucket", "term", "block", "cell", "first_id", "last_id")
    found = probes.select("query_id", "doc_id", "term", "cell").join(entries, ["term", "cell"]).where(inside)
    # A block is intersected once for each query, with the candidates that stand in its range.
    grouped = cut_lineage(
        found.groupBy("query_id", *key).agg(F.collect_set("doc_id").alias("wanted"))
    )
    needed, _ = short_list(grouped.select(*key).distinct())
    read = blocks.join(needed, key, "left_semi")
    met = grouped.join(read, key).select("query_id", F.explode(F.array_intersect("doc_ids", "wanted")).alias("doc_id"))
    n_others = others.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    hits = met.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("_hits"))
    several = hits.join(n_others, "query_id").where(F.col("_hits") == F.col("_n")).select("query_id", "doc_id")
    single = candidates.join(n_others, "query_id", "left_anti")
    return several.unionByName(single), seeds.select(*key).unionByName(needed).distinct()
