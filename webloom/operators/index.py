"""Inverted index: normalisation, postings, frequencies and conjunctive search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import text as text_fn
from webloom.functions.stem import stem_series
from webloom.operators.skew import HOT_ROWS, hot_keys, join_skewed
from webloom.session import cut_lineage


def index_tokens(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stop_words: DataFrame | None = None,
    strip_stop_apostrophe: bool = False,
    keep_empty: bool = False,
    repeats: bool = True,
) -> DataFrame:
    """Token stream ``(doc_id, pos, term)`` without stop words; order and repeats are kept. Without
    ``repeats`` a row gives each term once, and ``pos`` counts these.

    The built-in stop list is a fixed set inside the expression, so nothing is joined. A list of
    one's own comes as a DataFrame with a ``word`` column.
    """
    terms = text_fn.tokens(F.col(text), keep_empty)
    # An inner explode would make the optimizer copy the token expression into a filter below it,
    # and tokenise twice; rows without tokens are dropped by the null test instead.
    stream = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.posexplode_outer(terms if repeats else F.array_distinct(terms)).alias("pos", "term"),
    ).where(F.col("term").isNotNull())
    if stop_words is None:
        return stream.where(~text_fn.is_stop_word(F.col("term"), strip_stop_apostrophe))
    listed = stop_words.select(F.col("word").alias("term")).distinct()
    return stream.join(listed, "term", "left_anti").select("doc_id", "pos", "term")


def stem_vocabulary(terms: DataFrame, term: str = "term") -> DataFrame:
    """``(term, stem)`` for every distinct term: the stemmer runs once for each, in Arrow batches."""
    stem = F.pandas_udf(stem_series, "string")
    return terms.select(F.col(term).alias("term")).distinct().withColumn("stem", stem("term"))


# Bytes of a list of terms that goes to every task instead of moving the postings it is joined with.
LISTED_BYTES = 64 << 20


def short_list(listed: DataFrame, most: int | None = None) -> tuple[DataFrame, bool]:
    """The list, written and measured: up to ``most`` bytes it is short, and joins broadcast it."""
    listed = cut_lineage(listed)
    # Sixty-four bytes for the row beside its text.
    texts = [f.name for f in listed.schema.fields if f.dataType.simpleString() == "string"]
    row = sum((F.octet_length(c) for c in texts), F.lit(64))
    size = listed.agg(F.sum(row.cast("bigint"))).first()[0] or 0
    short = size <= (LISTED_BYTES if most is None else most)
    return (F.broadcast(listed) if short else listed), short


def join_terms(
    postings_table: DataFrame, listed: DataFrame, hot: DataFrame, most: int | None = None
) -> DataFrame:
    """Join postings with a table that has each term once. It is written and measured; up to ``most``
    bytes are broadcast, so the postings stay where they are; a longer one is joined with salting."""
    listed, short = short_list(listed, most)
    return postings_table.join(listed, "term") if short else join_skewed(postings_table, listed, ["term"], hot=hot)


def with_stems(tokens: DataFrame) -> DataFrame:
    """Replace ``term`` by its stem. A frequent term may fill a third of the stream, which is written
    once and then counted and joined. For an index take ``term_postings``, which stems less."""
    columns = tokens.columns
    written = cut_lineage(tokens)
    return (
        join_skewed(written, stem_vocabulary(written), ["term"])
        .withColumn("term", F.col("stem"))
        .select(*columns)
    )


def normalize(docs: DataFrame, stem: bool = False, **options) -> DataFrame:
    """Tokenise, drop stop words and optionally stem."""
    tokens = index_tokens(docs, **options)
    return with_stems(tokens) if stem else tokens


def stem_postings(plain: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Postings of stems from postings of plain terms, which are written once: their frequencies give
    both the vocabulary to stem and the frequent terms to split. The stems come to the postings while
    they are few."""
    plain = cut_lineage(plain)
    dictionary = doc_frequency(plain)
    frequent = hot_keys(dictionary, ["term"], min_rows, weight="df")
    stemmed = join_terms(plain, stem_vocabulary(dictionary), frequent)
    return stemmed.select(F.col("stem").alias("term"), "doc_id").distinct()


def term_postings(docs: DataFrame, stem: bool = False, **options) -> DataFrame:
    """Long postings of a corpus, of stems if asked for. Texts are tokenised once."""
    long = postings(index_tokens(docs, **options))
    return stem_postings(long) if stem else long


def term_sequence(tokens: DataFrame) -> DataFrame:
    """``(term, doc_id)`` with repeats in term, document order.

    Ranges are cut on both columns, so a frequent term spreads over many sorted partitions.
    """
    pairs = tokens.select("term", "doc_id")
    return pairs.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")


def postings(tokens: DataFrame) -> DataFrame:
    """Long postings ``(term, doc_id)``, each pair once."""
    return tokens.select("term", "doc_id").distinct()


# Ids that stand in several rows; a longer list is not broadcast.
REPEATED_IDS = 1_000_000


def document_postings(docs: DataFrame) -> DataFrame:
    """Long postings ``(term, doc_id)`` of documents ``(doc_id, text)``, each pair once.

    A document whose id stands in one row gives each of its terms once where it is. Only the tokens of
    ids that come again go through the shuffle of ``postings``; if those ids are very many, all do.
    """
    counted = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = cut_lineage(counted.where("n > 1").select(F.col("doc_id").alias("_again")))
    if again.count() > REPEATED_IDS:
        return postings(normalize(docs))
    # Rows without an id are one document.
    same = F.col("doc_id").eqNullSafe(F.col("_again"))
    single = docs.join(F.broadcast(again), same, "left_anti")
    several = docs.join(F.broadcast(again), same, "left_semi")
    once = normalize(single, repeats=False).select("term", "doc_id")
    return once.unionByName(postings(normalize(several)))


def doc_frequency(postings_table: DataFrame) -> DataFrame:
    """``(term, df)`` from distinct postings, counted before the shuffle."""
    return postings_table.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def postings_blocks(postings_table: DataFrame, span: int = 65536) -> DataFrame:
    """Export form: sorted document lists in blocks ``(term, block, doc_ids)``.

    A block covers ``span`` consecutive integer document ids, so no list is longer than that,
    however frequent the term. The blocks of a term in order are its whole sorted list.
    """
    if span <= 0:
        raise ValueError("span must be greater than 0")
    block = F.floor(F.col("doc_id") / span)
    return (
        postings_table.withColumn("block", block)
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_set("doc_id")).alias("doc_ids"))
    )


def append_postings(old: DataFrame, new: DataFrame) -> DataFrame:
    """Postings to add to ``old``: those of ``new`` not yet there."""
    return postings(new).join(old.select("term", "doc_id"), ["term", "doc_id"], "left_anti")


def refreshed_frequency(old: DataFrame, added: DataFrame) -> DataFrame:
    """``(term, df_before, df_after)`` when the postings ``added`` join ``old``."""
    counted = old.select("term", F.lit(1).alias("before"), F.lit(0).alias("new")).unionByName(
        added.select("term", F.lit(0).alias("before"), F.lit(1).alias("new"))
    )
    return counted.groupBy("term").agg(
        F.sum("before").alias("df_before"), F.sum(F.col("before") + F.col("new")).alias("df_after")
    )


def build_index(docs: DataFrame, stem: bool = False, **options) -> tuple[DataFrame, DataFrame]:
    """The long postings table and the term dictionary of a corpus."""
    long = term_postings(docs, stem, **options)
    return long, doc_frequency(long)


def query_terms(queries: DataFrame, stem: bool = False, **options) -> DataFrame:
    """Distinct normalised terms ``(query_id, term)``. AND and and vanish as stop words."""
    named = queries.select(F.col("query_id").alias("doc_id"), "text")
    terms = term_postings(named, stem, **options)
    return terms.select(F.col("doc_id").alias("query_id"), "term")


def boolean_query(
    terms: DataFrame,
    postings_table: DataFrame,
    dictionary: DataFrame | None = None,
    **skew_options,
) -> DataFrame:
    """Documents that hold all terms of a query, for a whole batch: ``(query_id, doc_id)``.

    Each query starts from its rarest term, whose postings are the only candidates, and checks
    the other terms on ``(doc_id, term)``, a key that occurs once. The postings of frequent terms
    are never fanned out unless a query has nothing rarer. A query with an unknown term, or with
    no term at all, finds nothing.
    """
    dictionary = doc_frequency(postings_table) if dictionary is None else dictionary
    rated = terms.join(dictionary, "term", "left")
    per_query = (
        rated.groupBy("query_id")
        .agg(
            F.count(F.lit(1)).alias("n_terms"),
            F.count("df").alias("n_known"),
            F.min(F.struct("df", "term")).alias("rarest"),
            # The terms of one query come from one text value, which bounds the list.
            F.collect_list("term").alias("terms"),
        )
        .where(F.col("n_terms") == F.col("n_known"))
        .select("query_id", "terms", F.col("rarest.term").alias("term"))
    )
    frequent = hot_keys(
        dictionary, ["term"], skew_options.pop("min_rows", 500_000), weight="df"
    )
    # Only postings of terms that are asked for go any further. Spark broadcasts the terms while
    # they are few.
    asked = terms.select("term").distinct()
    relevant = join_skewed(
        postings_table, asked, ["term"], "left_semi", hot=frequent, **skew_options
    )
    candidates = join_skewed(relevant, per_query, ["term"], hot=frequent, **skew_options)
    wanted = candidates.select(
        "query_id",
        "doc_id",
        F.size("terms").alias("n_terms"),
        F.explode_outer("terms").alias("term"),
    )
    return (
        wanted.join(relevant, ["doc_id", "term"], "left_semi")
        .groupBy("query_id", "doc_id", "n_terms")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where(F.col("hits") == F.col("n_terms"))
        .select("query_id", "doc_id")
    )


def intersect_terms(pairs: DataFrame, postings_table: DataFrame) -> DataFrame:
    """Two-term postings intersection for a table ``(pair_id, term1, term2)``.

    Rows are ``(pair_id, doc_id)``; each pair is a conjunctive query of two terms.
    """
    terms = pairs.select(
        F.col("pair_id").alias("query_id"), F.explode(F.array("term1", "term2")).alias("term")
    ).distinct()
    return boolean_query(terms, postings_table).withColumnRenamed("query_id", "pair_id")


def intersect_lists(list1: Column, list2: Column) -> Column:
    """Shared entries of two sorted document lists, sorted."""
    return F.sort_array(F.array_intersect(list1, list2))
