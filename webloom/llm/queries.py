"""The operators bound to the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.llm import (
    alignment,
    archive,
    decontam,
    forest_join,
    infill,
    langid,
    licences,
    mixing,
    packing,
    page_diff,
    quality,
    severity,
    shards,
)
from webloom.plans.registry import Query

QUERIES: dict[str, Query] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = Query(build, sql)
        return build

    return register


@query("op1_quality_rules")
def op1(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\r\f\v]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)),
    lambda i: array_to_string(w[i:i + 4], ' ')))) AS members
  FROM words WHERE len(w) > 0),
prints AS (SELECT doc_id, sha256(array_to_string(members, '|')) AS print, members FROM sets),
heads AS (
  SELECT print, min(doc_id) AS rep, count(*) AS n, any_value(members) AS members FROM prints GROUP BY print),
grams AS (SELECT rep, len(members) AS size, unnest(members) AS gram FROM heads),
pairs AS (
  SELECT a.rep AS x, b.rep AS y FROM grams a JOIN grams b ON a.gram = b.gram AND a.rep < b.rep
    AND 5 * b.size >= 4 * a.size AND 5 * a.size >= 4 * b.size
  GROUP BY a.rep, b.rep, a.size, b.size
  HAVING 5 * count(*) >= 4 * (a.size + b.size - count(*))),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT rep, rep AS root FROM heads UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.rep),
classes AS (SELECT rep, min(root) AS class_id FROM reach GROUP BY rep),
counts AS (SELECT x AS rep, count(*) AS n_links FROM links GROUP BY x)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(h.rep, d.doc_id) AS copy_id,
  coalesce(h.n, 1) AS n_copies, coalesce(k.n_links, 0) AS n_links
FROM documents d LEFT JOIN prints s ON s.doc_id = d.doc_id LEFT JOIN heads h ON h.print = s.print
LEFT JOIN classes c ON c.rep = h.rep LEFT JOIN counts k ON k.rep = h.rep
"""


@query("op2_ngram_join", OP2_SQL)
def op2(spark, sf_dir):
    return forest_join.similarity_classes(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, text FROM documents),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start,
    row_number() OVER (ORDER BY doc_id, size) AS place, sum(size) OVER () AS total FROM sized),
cut AS (
  SELECT *, least(((2 * start + size) * 24) // (2 * total), 23) AS shard FROM placed)
SELECT doc_id, size, 'bytes' AS law, shard::INTEGER AS shard,
  place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard,
  CRC AS text_crc32
FROM cut
"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of a text's bytes in SQL: a reduction over bytes with the reflected polynomial."""
    step = (
        "list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    )
    octets = f"list_transform(range(1, 2 * strlen({text}), 2), lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda acc, b: {step}), 4294967295)"


@query("op3_byte_shards", OP3_SQL.replace("CRC", _crc32_sql("coalesce(text, '')")))
def op3(spark, sf_dir):
    return shards.shard_table(table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS owner FROM pages)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < owner THEN owner END AS refers_to
FROM hashed
"""


@query("op4_archive", OP4_SQL)
def op4(spark, sf_dir):
    return archive.record_index(archive.stored_once(archive.build(table(spark, sf_dir, "pages"))))


@query("op5_page_differencing")
def op5(spark, sf_dir):
    return page_diff.main_text(table(spark, sf_dir, "pages"))


@query("op6_toxic_severity")
def op6(spark, sf_dir):
    return severity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP7_SQL = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM low, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, item, i, p.size FROM places p JOIN windows USING (size, win)),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT l.doc_id, len(l.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM low l LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""


@query("op7_decontamination", OP7_SQL)
def op7(spark, sf_dir):
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_language_id")
def op8(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op9_domain_mixing")
def op9(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op10_sql() -> str:
    """The same scan in SQL. Sentences of one rule follow each other among the known ones, so a rule
    is a piece of the joined identifiers; the longest rules come first at each place."""
    known = ", ".join(
        f"('{text}', '{name}')" for text, name in sorted(licences.known_sentences().items())
    )
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
cut AS (
  SELECT doc_id, list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), '\n|[.!?:;]+[ \t\r\f\v]'),
    lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS sentences FROM documents),
placed AS (SELECT doc_id, unnest(sentences) AS sentence, unnest(range(len(sentences))) AS place FROM cut),
found AS (SELECT doc_id, place, id FROM placed JOIN known USING (sentence)),
single(id, licence) AS (VALUES {", ".join(f"('{r[0]}', '{name}')" for name, r in licences.RULES if len(r) == 1)}),
named AS (
  SELECT doc_id, count(*) AS n_known, count(licence) AS n_matches,
    coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence), '') AS licences
  FROM found LEFT JOIN single USING (id) GROUP BY doc_id)
SELECT c.doc_id, len(c.sentences) AS n_sentences, coalesce(n.n_known, 0) AS n_known,
  coalesce(n.n_matches, 0) AS n_matches, coalesce(n.licences, '') AS licences
FROM cut c LEFT JOIN named n USING (doc_id)
"""


# The tables hold short notices only, so the SQL needs rules of one sentence alone; tests compare the
# sequences with brute force.
@query("op10_licence_scan", _op10_sql())
def op10(spark, sf_dir):
    return licences.licence_table(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256('7:' || doc_id) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
    list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS d FROM cut),
placed AS (
  SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 100
      THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:], '') AS suffix FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""


@query("op11_fill_in_middle", OP11_SQL)
def op11(spark, sf_dir):
    return infill.digests(infill.rearranged(table(spark, sf_dir, "documents")))


@query("op12_sequence_packing")
def op12(spark, sf_dir):
    return packing.packing_table(table(spark, sf_dir, "documents"))


@query("op13_token_alignment")
def op13(spark, sf_dir):
    return alignment.alignment_table(table(spark, sf_dir, "documents"))
