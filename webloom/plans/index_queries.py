"""Text and index queries over ``documents`` and ``benchmark``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import text as text_fn
from webloom.functions.fixed_values import STOP_WORDS, TOKEN_PUNCTUATION
from webloom.operators import index, stored_index
from webloom.operators.skew import hot_keys
from webloom.plans.bindings import table
from webloom.plans.registry import oracle, part, query
from webloom.session import cut_lineage, shared_folder

SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
SPACE_NOT_NEWLINE = r"[\t\x0b-\r\x1c-\x20\x{85}\p{Z}]"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def clean_sql(column: str) -> str:
    joined = f"regexp_replace({column}, '{SPACE_NOT_NEWLINE}*\\n{SPACE_NOT_NEWLINE}*', ' ', 'g')"
    return f"regexp_replace({joined}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def tokens_sql(column: str) -> str:
    spaced = f"regexp_replace({clean_sql(column)}, '{SPACE}* {SPACE}*', ' ', 'g')"
    # translate() needs a target here; deleting characters is a pattern of them.
    escaped = "".join("\\" + c for c in TOKEN_PUNCTUATION if c != "´") + "´"
    bare = f"regexp_replace(lower({spaced}), {sql_text('[' + escaped + ']')}, '', 'g')"
    return f"list_filter(string_split({bare}, ' '), lambda t: t <> '')"


STOP_LIST = ", ".join(sql_text(w) for w in STOP_WORDS)


def token_part(name: str, source: str, key: str) -> None:
    part(
        name,
        f"""
SELECT {key}, pos, term FROM (
  SELECT {key}, unnest(list) AS term, generate_subscripts(list, 1) - 1 AS pos
  FROM (SELECT {key}, {tokens_sql('text')} AS list FROM {source}))
WHERE term NOT IN ({STOP_LIST})""",
    )


token_part("tokens", "documents", "doc_id")
token_part("question_tokens", "benchmark", "item_id")
part("postings", "SELECT DISTINCT term, doc_id FROM tokens", "tokens")
part("dictionary", "SELECT term, count(*) AS df FROM postings GROUP BY term", "postings")
part("questions", "SELECT DISTINCT item_id AS query_id, term FROM question_tokens", "question_tokens")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def postings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.document_postings(documents(spark, sf_dir))


def asked_postings(spark: SparkSession, sf_dir: str, terms: DataFrame) -> DataFrame:
    """The postings of the terms of a batch of searches. Tokens nobody asks for go before any
    shuffle, so the index of the whole corpus is neither built nor written."""
    asked = terms.select("term").distinct()
    tokens = index.normalize(documents(spark, sf_dir)).join(asked, "term", "left_semi")
    return cut_lineage(index.postings(tokens))


@query(
    "corpus_scan",
    "SELECT source AS host, doc_id, coalesce(text, '') AS text FROM documents",
)
def corpus_scan(spark, sf_dir):
    text = F.coalesce("text", F.lit("")).alias("text")
    return table(spark, sf_dir, "documents").select(F.col("source").alias("host"), "doc_id", text)


@query("clean_text", f"SELECT doc_id, {clean_sql('text')} AS text FROM documents")
def clean_text(spark, sf_dir):
    cleaned = text_fn.clean_text(F.col("text")).alias("text")
    return documents(spark, sf_dir).select("doc_id", cleaned)


@query("index_tokens", oracle("SELECT doc_id, pos::INTEGER AS pos, term FROM tokens", "tokens"))
def index_tokens(spark, sf_dir):
    return index.index_tokens(documents(spark, sf_dir))


@query("stem_terms")
def stem_terms(spark, sf_dir):
    return index.stem_vocabulary(index.index_tokens(documents(spark, sf_dir)))


@query("term_sequence", oracle("SELECT term, doc_id FROM tokens", "tokens"))
def term_sequence(spark, sf_dir):
    return index.term_sequence(index.index_tokens(documents(spark, sf_dir)))


@query("postings", oracle("SELECT term, doc_id FROM postings", "postings"))
def postings(spark, sf_dir):
    return postings_table(spark, sf_dir)


@query("doc_frequency", oracle("SELECT term, df FROM dictionary", "dictionary"))
def doc_frequency(spark, sf_dir):
    return index.doc_frequency(postings_table(spark, sf_dir))


@query(
    "build_index",
    oracle(
        """
SELECT term, doc_id // 256 AS block, count(*)::INTEGER AS n,
  string_agg(doc_id, ' ' ORDER BY doc_id) AS doc_ids
FROM postings GROUP BY ALL""",
        "postings",
    ),
)
def build_index(spark, sf_dir):
    long, _ = index.build_index(documents(spark, sf_dir))
    return index.postings_blocks(long, span=256).select(
        "term", "block", F.size("doc_ids").alias("n"), F.array_join("doc_ids", " ").alias("doc_ids")
    )


@query("build_index_stemmed")
def build_index_stemmed(spark, sf_dir):
    """The index of word stems with the frequency of each."""
    long = cut_lineage(index.term_postings(documents(spark, sf_dir), stem=True))
    dictionary = cut_lineage(index.doc_frequency(long))
    return index.join_terms(long, dictionary, hot_keys(dictionary, ["term"], weight="df"))


@query(
    "index_append",
    oracle(
        """
SELECT term, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en'))
    AS df_before, count(*) AS df_after
FROM postings GROUP BY term""",
        "postings",
    ),
)
def index_append(spark, sf_dir):
    """The English part is indexed already when the whole corpus arrives."""
    docs = table(spark, sf_dir, "documents")
    old = cut_lineage(index.postings(index.normalize(docs.where(F.col("lang") == "en"))))
    added = index.append_postings(old, index.normalize(docs))
    return index.refreshed_frequency(old, added)


@query(
    "boolean_query",
    oracle(
        """
SELECT query_id, doc_id FROM questions JOIN postings USING (term)
JOIN (SELECT query_id, count(*) AS n_terms FROM questions GROUP BY query_id) USING (query_id)
GROUP BY query_id, doc_id, n_terms HAVING count(*) = n_terms""",
        "questions",
        "postings",
    ),
)
def boolean_query(spark, sf_dir):
    """Every ``benchmark`` passage as a conjunctive query over ``documents``."""
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    terms = index.query_terms(questions)
    return index.boolean_query(terms, asked_postings(spark, sf_dir, terms))


@query("boolean_query_stemmed")
def boolean_query_stemmed(spark, sf_dir):
    """The same searches by stems: plain terms whose stem nobody asks for go before any shuffle of
    postings."""
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    terms = cut_lineage(index.query_terms(questions, stem=True))
    tokens = index.index_tokens(documents(spark, sf_dir))
    asked = terms.select(F.col("term").alias("stem")).distinct()
    vocabulary = index.stem_vocabulary(tokens).join(asked, "stem", "left_semi")
    # As many terms as have one of the asked stems; Spark broadcasts them while they are few.
    found = index.postings(tokens.join(vocabulary.select("term"), "term", "left_semi"))
    return index.boolean_query(terms, cut_lineage(index.stem_postings(found)))


@query(
    "postings_intersect",
    oracle(
        """
SELECT pair_id, doc_id
FROM (SELECT pair_id, term, count(*) OVER (PARTITION BY pair_id) AS n_terms
      FROM (SELECT DISTINCT pair_id, unnest([term1, term2]) AS term
            FROM (SELECT query_id AS pair_id, min(term) AS term1, max(term) AS term2
                  FROM questions GROUP BY query_id)))
JOIN postings USING (term)
GROUP BY pair_id, doc_id, n_terms HAVING count(*) = n_terms""",
        "questions",
        "postings",
    ),
)
def postings_intersect(spark, sf_dir):
    """First and last term of every ``benchmark`` passage."""
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    terms = index.query_terms(questions)
    pairs = (
        terms.groupBy(F.col("query_id").alias("pair_id"))
        .agg(F.min("term").alias("term1"), F.max("term").alias("term2"))
    )
    return index.intersect_terms(pairs, asked_postings(spark, sf_dir, terms))


@query(
    "index_search_stored",
    oracle(
        """
SELECT query_id, doc_id FROM questions JOIN postings USING (term)
JOIN (SELECT query_id, count(*) AS n_terms FROM questions GROUP BY query_id) USING (query_id)
GROUP BY query_id, doc_id, n_terms HAVING count(*) = n_terms
UNION ALL
SELECT 'rare ' || q.term AS query_id, doc_id FROM (SELECT DISTINCT term FROM questions) q JOIN postings USING (term)
JOIN dictionary d USING (term) WHERE d.df <= 20""",
        "questions",
        "postings",
        "dictionary",
    ),
)
def index_search_stored(spark, sf_dir):
    """The index of all documents is written, read back and searched: for every ``benchmark`` passage,
    and for each of its rarer terms alone."""
    path = f"{shared_folder(spark)}/index"
    stored_index.write_stored_index(postings_table(spark, sf_dir), path)
    blocks, directory = stored_index.read_stored_index(spark, path)
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    terms = cut_lineage(index.query_terms(questions))
    known = directory.where("block = 0 and df <= 20").select("term")
    rare = terms.select("term").distinct().join(known, "term", "left_semi")
    asked = terms.select(F.col("query_id").cast("string").alias("query_id"), "term").unionByName(
        rare.select(F.concat(F.lit("rare "), "term").alias("query_id"), "term")
    )
    return stored_index.search_stored(asked, blocks, directory)
