"""Inputs of the registered queries, all derived by Spark from the given tables.

Each function has a common table expression of the same name in SQL, defined next to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import urls
from webloom.operators.factorize import last_rating
from webloom.operators.frontier import host_schedule, to_frontier
from webloom.operators.links import extract_links
from webloom.plans.registry import part
from webloom.session import SPREAD_TEXTS, cut_lineage


# Tables whose rows are costly to work on.
TEXT_TABLES = ("documents", "pages")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, in the splits of its files. A session whose files have a single row group, as
    those of tests and benches, asks for text tables in ``SPREAD_TEXTS`` partitions instead."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spread = spark.conf.get(SPREAD_TEXTS, None)
    return rows.repartition(int(spread)) if spread and name in TEXT_TABLES else rows


# --- pages with links of all kinds -----------------------------------------------------------

URL_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*:)"
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with a footer of links: to two other pages and one of each special kind."""
    pages = table(spark, sf_dir, "pages")
    n = pages.select(F.count(F.lit(1))).scalar()
    # Addresses alone are joined; html meets its finished footer in one join. A page without the
    # other page links to itself.
    address = pages.select("page_id", "url")
    first = address.withColumnsRenamed({"page_id": "first_id", "url": "first_url"})
    second = address.withColumnsRenamed({"page_id": "second_id", "url": "second_url"})
    joined = (
        address.withColumn("first_id", (F.col("page_id") * 7 + 1) % n)
        .withColumn("second_id", (F.col("page_id") * 3 + 2) % n)
        .join(first, "first_id", "left")
        .join(second, "second_id", "left")
        .withColumn("first_url", F.coalesce("first_url", "url"))
        .withColumn("second_url", F.coalesce("second_url", "url"))
    )
    no = F.col("page_id").cast("string")
    first_url, second_url = F.col("first_url"), F.col("second_url")
    footer = F.concat(
        *[
            piece if isinstance(piece, Column) else F.lit(piece)
            for piece in (
                '<footer><a href="', first_url, '">next</a>',
                "<a class=\"x\" href='", second_url, "'>other</a>",
                '<a href="mailto:web@', urls.host(first_url), '">mail</a>',
                '<a href="tel:', no, '">call</a>',
                "<a href=/files/", no, ".pdf>pdf</a>",
                '<a href="/files/', no, '.PDF">scan</a>',
                '<a href="/files/list.pdf?v=', no, '">list</a>',
                '<A HREF = "//', urls.host(second_url), "/news/", no, '/">news</A>',
                '<a href="?page=', no, '">page</a><a href="#part', no, '">part</a>',
                '<a href="more/', no, '.html">more</a><a href="/a&amp;b/', no, '//">and</a>',
                '<!-- <a href="/comment/', no, '">x</a> -->',
                "<script>var a='<a href=\"/script/", no, "\">x</a>';</script></footer>",
            )
        ]
    )
    footers = joined.select("page_id", footer.alias("footer"))
    both = pages.join(footers, "page_id", "left")
    return both.select("page_id", "url", F.concat("html", "footer").alias("html"))


part(
    "linked_pages",
    f"""
SELECT p.page_id, p.url, concat(p.html,
  '<footer><a href="', coalesce(f.url, p.url), '">next</a>',
  '<a class="x" href=''', coalesce(s.url, p.url), '''>other</a>',
  '<a href="mailto:web@', regexp_extract(coalesce(f.url, p.url), '{HOST}', 1), '">mail</a>',
  '<a href="tel:', p.page_id, '">call</a>',
  '<a href=/files/', p.page_id, '.pdf>pdf</a>',
  '<a href="/files/', p.page_id, '.PDF">scan</a>',
  '<a href="/files/list.pdf?v=', p.page_id, '">list</a>',
  '<A HREF = "//', regexp_extract(coalesce(s.url, p.url), '{HOST}', 1), '/news/', p.page_id, '/">news</A>',
  '<a href="?page=', p.page_id, '">page</a><a href="#part', p.page_id, '">part</a>',
  '<a href="more/', p.page_id, '.html">more</a><a href="/a&amp;b/', p.page_id, '//">and</a>',
  '<!-- <a href="/comment/', p.page_id, '">x</a> -->',
  '<script>var a=''<a href="/script/', p.page_id, '">x</a>'';</script></footer>') AS html
FROM pages p
LEFT JOIN pages f ON f.page_id = (p.page_id * 7 + 1) % (SELECT count(*) FROM pages)
LEFT JOIN pages s ON s.page_id = (p.page_id * 3 + 2) % (SELECT count(*) FROM pages)""",
)

HIDDEN = (
    r"(?is)<!--.*?-->|<script(?:\s[^>]*)?>.*?</script\s*>|<style(?:\s[^>]*)?>.*?</style\s*>"
)
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)"""

part(
    "hrefs",
    f"""
SELECT page_id, src_url, replace(regexp_replace(raw, '^["'']|["'']$', '', 'g'), '&amp;', '&') AS href
FROM (SELECT page_id, url AS src_url,
        unnest(regexp_extract_all(regexp_replace(html, '{HIDDEN}', '', 'g'), '{ANCHOR}', 1)) AS raw
      FROM linked_pages WHERE html <> '')""",
    "linked_pages",
)

part(
    "all_links",
    f"""
SELECT page_id, src_url, href, rtrim(CASE
  WHEN href = '' THEN src_url
  WHEN regexp_matches(href, '{URL_SCHEME}') THEN href
  WHEN starts_with(href, '//') THEN regexp_extract(src_url, '{URL_SCHEME}', 1) || href
  WHEN starts_with(href, '/') THEN regexp_extract(src_url, '^([^/]*//[^/?#]*)', 1) || href
  WHEN starts_with(href, '?')
    THEN regexp_extract(src_url, '^([^/]*//[^/?#]*)', 1) || regexp_extract(src_url, '{PATH}', 1) || href
  WHEN starts_with(href, '#') THEN regexp_replace(src_url, '#.*$', '') || href
  ELSE regexp_extract(src_url, '^([^/]*//[^/?#]*)', 1)
    || regexp_extract(regexp_extract(src_url, '{PATH}', 1), '^(.*/)', 1) || href END, '/') AS url
FROM hrefs""",
    "hrefs",
)

part(
    "links",
    """
SELECT DISTINCT page_id, src_url, url FROM all_links
WHERE NOT starts_with(href, 'mailto:') AND NOT starts_with(href, 'tel:')
  AND NOT regexp_matches(href, '\\.(jpg|jpeg|png|gif|svg|pdf|mp4|mp3|avi|mov|zip)$')""",
    "all_links",
)


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_links(linked_pages(spark, sf_dir)).select("page_id", "src_url", "url")


def stored_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The link table, written once: operators that pass over it more than once then read short
    addresses and do not parse the pages again."""
    return cut_lineage(links(spark, sf_dir))


def crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(urls.normalize(F.col("url")).alias("url"))


part("crawled", "SELECT rtrim(url, '/') AS url FROM pages")

# --- robots texts ----------------------------------------------------------------------------


def robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robots text for each host, made of the host's own page paths."""
    pages = table(spark, sf_dir, "pages").select(
        urls.host(F.col("url")).alias("host"), urls.path(F.col("url")).alias("path")
    )
    folder = F.regexp_extract("path", "^(/[^/]*/)", 1)
    facts = pages.groupBy("host").agg(
        F.min(folder).alias("folder"),
        F.min("path").alias("first_path"),
        F.max("path").alias("last_path"),
        F.count(F.lit(1)).alias("n"),
    )
    lines = (
        ("# robots of ", "host"),
        ("User-agent: *",),
        ("Allow: ", "first_path"),
        ("Disallow: ", "folder"),
        ("Disallow: ", "last_path", " # last"),
        ("Crawl-delay: ", "n"),
        ("",),
        ("User-agent: OldBot",),
        ("User-Agent: IndexBot",),
        ("Disallow: /files/",),
        ("Disallow:",),
        ("disallow : /news",),
        ("",),
        ("User-agent: OldBot",),
        ("Disallow: /",),
        ("Sitemap: https://", "host", "/sitemap.xml"),
        ("Sitemap: https://", "host", "/", "folder"),
    )
    columns = set(facts.columns)
    text = [
        F.concat(*[F.col(p).cast("string") if p in columns else F.lit(p) for p in line])
        for line in lines
    ]
    return facts.select("host", F.concat_ws("\n", *text).alias("robots_txt"))


part(
    "robots",
    f"""
SELECT host, concat_ws(chr(10), '# robots of ' || host, 'User-agent: *', 'Allow: ' || first_path,
  'Disallow: ' || folder, 'Disallow: ' || last_path || ' # last', 'Crawl-delay: ' || n, '',
  'User-agent: OldBot', 'User-Agent: IndexBot', 'Disallow: /files/', 'Disallow:',
  'disallow : /news', '', 'User-agent: OldBot', 'Disallow: /',
  'Sitemap: https://' || host || '/sitemap.xml', 'Sitemap: https://' || host || '/' || folder
  ) AS robots_txt
FROM (SELECT host, min(regexp_extract(path, '^(/[^/]*/)', 1)) AS folder, min(path) AS first_path,
        max(path) AS last_path, count(*) AS n
      FROM (SELECT regexp_extract(url, '{HOST}', 1) AS host, regexp_extract(url, '{PATH}', 1) AS path
            FROM pages) GROUP BY host)""",
)

# Rules with wildcards, made of aggregates of a host's page paths: key, then pieces.
PATTERN_LINES = (
    ("Disallow: ", "folder", "*", "first_end", "$"),
    ("Allow: ", "folder", "*", "last_end"),
    ("Disallow: /*?page=",),
    ("Allow: ", "first_path"),
    ("Disallow: ", "last_folder"),
    ("Allow: ", "last_folder", "*", "first_end", "*"),
    ("Disallow: /*/*", "last_end", "$"),
    ("Allow: /*.html$",),
    ("Disallow: ", "last_path", "*$"),
)


def pattern_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robots text with wildcard rules for each host, of a fixed number of lines."""
    pages = table(spark, sf_dir, "pages").select(
        urls.host(F.col("url")).alias("host"), urls.path(F.col("url")).alias("path")
    )
    folder = F.regexp_extract("path", "^(/[^/]*/)", 1)
    facts = pages.groupBy("host").agg(
        F.min(folder).alias("folder"),
        F.max(folder).alias("last_folder"),
        F.min("path").alias("first_path"),
        F.max("path").alias("last_path"),
        F.min(F.right("path", F.lit(1))).alias("first_end"),
        F.max(F.right("path", F.lit(1))).alias("last_end"),
    )
    columns = set(facts.columns)
    text = [F.lit("User-agent: *")] + [
        F.concat(*[F.col(p) if p in columns else F.lit(p) for p in line]) for line in PATTERN_LINES
    ]
    return facts.select("host", F.concat_ws("\n", *text).alias("robots_txt"))


part(
    "pattern_rules",
    f"""
SELECT DISTINCT host, rule.allow AS allow, rule.path AS path,
  '^' || replace(regexp_replace(regexp_replace(rule.path, '\\$$', ''), '[.?+(){{}}\\[\\]^$|\\\\]', '\\\\\\0', 'g'), '*', '.*')
    || CASE WHEN rule.path LIKE '%$' THEN '$' ELSE '' END AS pattern
FROM (SELECT host, unnest([
    {{'allow': false, 'path': folder || '*' || first_end || '$'}},
    {{'allow': true, 'path': folder || '*' || last_end}},
    {{'allow': false, 'path': '/*?page='}},
    {{'allow': true, 'path': first_path}},
    {{'allow': false, 'path': last_folder}},
    {{'allow': true, 'path': last_folder || '*' || first_end || '*'}},
    {{'allow': false, 'path': '/*/*' || last_end || '$'}},
    {{'allow': true, 'path': '/*.html$'}},
    {{'allow': false, 'path': last_path || '*$'}}]) AS rule
  FROM (SELECT host, min(regexp_extract(path, '^(/[^/]*/)', 1)) AS folder,
          max(regexp_extract(path, '^(/[^/]*/)', 1)) AS last_folder, min(path) AS first_path,
          max(path) AS last_path, min(right(path, 1)) AS first_end, max(right(path, 1)) AS last_end
        FROM (SELECT regexp_extract(url, '{HOST}', 1) AS host, regexp_extract(url, '{PATH}', 1) AS path
              FROM pages) GROUP BY host))
WHERE rule.path <> ''""",
)

part(
    "robots_lines",
    """
SELECT host, line_no, raw, trim(split_part(raw, '#', 1)) AS line,
  CASE WHEN contains(split_part(raw, '#', 1), ':')
       THEN lower(trim(split_part(split_part(raw, '#', 1), ':', 1))) END AS key,
  trim(regexp_extract(split_part(raw, '#', 1), '^[^:]*:(.*)$', 1)) AS value
FROM (SELECT host, unnest(string_split(robots_txt, chr(10))) AS raw,
        generate_subscripts(string_split(robots_txt, chr(10)), 1) - 1 AS line_no FROM robots)""",
    "robots",
)

part(
    "robots_blocks",
    """
SELECT *, sum(CASE WHEN key = 'user-agent' THEN 1 ELSE 0 END)
    OVER (PARTITION BY host ORDER BY line_no) AS block
FROM robots_lines WHERE key IN ('user-agent', 'disallow')""",
    "robots_lines",
)

part(
    "robots_rules",
    """
SELECT a.host, a.agent, p.line_no, p.value AS path
FROM (SELECT host, value AS agent, max(block) AS block FROM robots_blocks
      WHERE key = 'user-agent' AND value <> '' GROUP BY ALL) a
JOIN robots_blocks p ON p.host = a.host AND p.block = a.block AND p.key = 'disallow' AND p.value <> ''""",
    "robots_blocks",
)

# --- frontier --------------------------------------------------------------------------------

BASE_TIME = "2024-01-01 00:00:00"


def base_time() -> Column:
    return F.lit(BASE_TIME).cast("timestamp_ntz")


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link targets, aged by the first page they are on; blog addresses get a middle priority."""
    return frontier_of(links(spark, sf_dir))


def stored_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(frontier(spark, sf_dir))


def frontier_of(found: DataFrame) -> DataFrame:
    middle = (F.col("priority") > 3) & F.col("url").contains("blog")
    return to_frontier(found.withColumnRenamed("page_id", "seq")).withColumn(
        "priority", F.when(middle, F.lit(3)).otherwise(F.col("priority"))
    )


part(
    "frontier",
    f"""
SELECT url, regexp_extract(url, '{HOST}', 1) AS host, min(page_id) AS seq,
  CASE WHEN contains(url, 'news') THEN 1 WHEN contains(url, 'blog') THEN 3 ELSE 5 END AS priority
FROM links WHERE regexp_extract(url, '{HOST}', 1) <> '' GROUP BY url""",
    "links",
)


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages count as visits, one second apart in page order."""
    visits = table(spark, sf_dir, "pages").select(
        urls.host(F.col("url")).alias("host"),
        (base_time() + F.make_dt_interval(secs=F.col("page_id"))).alias("visited"),
    )
    return host_schedule(visits)


part(
    "schedule",
    f"""
SELECT regexp_extract(url, '{HOST}', 1) AS host,
  max(TIMESTAMP '{BASE_TIME}' + to_seconds(page_id)) + to_seconds(1) AS next_time
FROM pages GROUP BY 1""",
)


def middle_time(spark: SparkSession, sf_dir: str) -> Column:
    """The time at which half of the pages have been visited."""
    pages = table(spark, sf_dir, "pages")
    half = pages.select(F.floor(F.max("page_id") / 2)).scalar()
    return base_time() + F.make_dt_interval(secs=half)


MIDDLE_TIME = f"(SELECT TIMESTAMP '{BASE_TIME}' + to_seconds(max(page_id) // 2) FROM pages)"

# --- ratings and items -----------------------------------------------------------------------


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as ratings ``(user, item, rating, seq)``; lines with the top tax rate give none."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    stars = F.when(F.col("l_tax") < 0.08, 1 + F.col("l_quantity") % 5)
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        stars.alias("rating"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_ratings(spark, sf_dir).na.drop()


part(
    "raw_ratings",
    """
SELECT o_custkey AS "user", l_partkey AS item,
  CASE WHEN l_tax < 0.08 THEN 1 + l_quantity % 5 END AS rating,
  l_orderkey * 10 + l_linenumber AS seq
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
part("ratings", "SELECT * FROM raw_ratings WHERE rating IS NOT NULL", "raw_ratings")


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, item_id, rating)``, one rating for each pair."""
    last = last_rating(ratings(spark, sf_dir))
    return last.withColumnsRenamed({"user": "user_id", "item": "item_id"})


part(
    "matrix",
    """
SELECT "user" AS user_id, item AS item_id, arg_max(rating, (seq, rating)) AS rating
FROM ratings GROUP BY "user", item""",
    "ratings",
)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as items; some have no description and some no usable price."""
    parts = table(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast("string")
    kind = F.col("p_type")
    return parts.select(
        F.col("p_partkey").alias("item"),
        F.array("p_type", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1))).alias("category"),
        F.when(kind != "PROMO", F.array("p_name", "p_brand")).alias("description"),
        F.when(kind == "SMALL", F.lit(""))
        .when(kind == "MEDIUM", price)
        .when(kind == "LARGE", F.lit("$1,000"))
        .when(kind == "ECONOMY", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("$"), price))
        .alias("price"),
    )


part(
    "items",
    """
SELECT p_partkey AS item, [p_type, p_brand, split_part(p_name, ' ', 1)] AS category,
  CASE WHEN p_type <> 'PROMO' THEN p_name || ' ' || p_brand ELSE '' END AS description,
  CASE p_type WHEN 'SMALL' THEN '' WHEN 'MEDIUM' THEN CAST(p_retailprice AS VARCHAR)
    WHEN 'LARGE' THEN '$1,000' WHEN 'ECONOMY' THEN NULL
    ELSE '$' || CAST(p_retailprice AS VARCHAR) END AS price
FROM part""",
)
