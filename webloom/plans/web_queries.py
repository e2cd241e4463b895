"""Page, link, robots and frontier queries over ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from webloom.functions import html as html_fn
from webloom.functions import urls
from webloom.operators import frontier as fr
from webloom.operators import links as ln
from webloom.operators import robots as rb
from webloom.plans import bindings as b
from webloom.plans.bindings import HIDDEN, HOST, MIDDLE_TIME, PATH
from webloom.plans.index_queries import clean_sql
from webloom.plans.registry import oracle, part, query

STAMP = "yyyy-MM-dd HH:mm:ss"
SQL_STAMP = "%Y-%m-%d %H:%M:%S"


def stamp(column: str):
    return F.date_format(column, STAMP).alias(column)


# --- pages and links -------------------------------------------------------------------------


@query(
    "page_scan",
    "SELECT page_id, url, html FROM pages WHERE html IS NOT NULL AND html <> ''",
)
def page_scan(spark, sf_dir):
    return ln.page_scan(b.table(spark, sf_dir, "pages"))


def page_text_sql() -> str:
    text = f"regexp_replace({clean_sql('html')}, '{HIDDEN}', '', 'g')"
    text = f"regexp_replace({text}, '(?s)<[/!?a-zA-Z][^>]*>', '', 'g')"
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{entity};', '{char}')"
    return text


@query("page_text", f"SELECT page_id, url, {page_text_sql()} AS text FROM pages")
def page_text(spark, sf_dir):
    return ln.page_text(b.table(spark, sf_dir, "pages"))


@query("extract_links", oracle("SELECT page_id, src_url, url FROM links", "links"))
def extract_links(spark, sf_dir):
    return b.links(spark, sf_dir)


@query("resolve_links", oracle("SELECT page_id, src_url, href, url FROM all_links", "all_links"))
def resolve_links(spark, sf_dir):
    found = ln.anchors(b.linked_pages(spark, sf_dir))
    url = urls.normalize(urls.resolve(F.col("src_url"), F.col("href")))
    return found.select("page_id", "src_url", "href", url.alias("url"))


@query("url_host", f"SELECT page_id, regexp_extract(url, '{HOST}', 1) AS host FROM pages")
def url_host(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages")
    return pages.select("page_id", urls.host(F.col("url")).alias("host"))


@query("url_normalize", "SELECT page_id, rtrim(url, '/') AS url FROM pages")
def url_normalize(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages")
    return pages.select("page_id", urls.normalize(F.col("url")).alias("url"))


@query(
    "url_filename",
    f"""SELECT page_id, regexp_extract(url, '{HOST}', 1)
  || replace(replace(regexp_extract(url, '{PATH}', 1), '/', '_'), ':', '-') || '.json' AS file_name
FROM pages""",
)
def url_filename(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages")
    return pages.select("page_id", urls.file_name(F.col("url")).alias("file_name"))


@query(
    "url_priority",
    oracle(
        """SELECT page_id, url, CASE WHEN contains(url, 'news') THEN 1 ELSE 5 END AS priority
FROM links""",
        "links",
    ),
)
def url_priority(spark, sf_dir):
    found = b.links(spark, sf_dir)
    return found.select("page_id", "url", urls.priority(F.col("url")).alias("priority"))


@query(
    "same_domain_links",
    oracle(
        f"""SELECT page_id, src_url, url FROM links
WHERE regexp_extract(url, '{HOST}', 1) = regexp_extract(src_url, '{HOST}', 1)""",
        "links",
    ),
)
def same_domain_links(spark, sf_dir):
    return ln.same_domain(b.links(spark, sf_dir))


@query(
    "seed_host_links",
    oracle(
        f"""SELECT page_id, src_url, url FROM links WHERE regexp_extract(url, '{HOST}', 1) IN (
  SELECT regexp_extract(url, '{HOST}', 1) FROM pages WHERE contains(url, '/en/'))""",
        "links",
    ),
)
def seed_host_links(spark, sf_dir):
    """Links to the hosts of all English pages, the seeds of this crawl."""
    seeds = b.table(spark, sf_dir, "pages").where(F.col("url").contains("/en/"))
    found = ln.on_seed_hosts(b.stored_links(spark, sf_dir), seeds)
    return found.select("page_id", "src_url", "url")


@query(
    "frontier_new",
    oracle(
        "SELECT DISTINCT url FROM links WHERE url NOT IN (SELECT url FROM crawled)",
        "links",
        "crawled",
    ),
)
def frontier_new(spark, sf_dir):
    return ln.new_links(b.links(spark, sf_dir), b.crawled(spark, sf_dir))


@query(
    "url_index",
    oracle("SELECT url FROM crawled UNION SELECT url FROM links", "links", "crawled"),
)
def url_index(spark, sf_dir):
    return ln.url_index(b.crawled(spark, sf_dir), b.links(spark, sf_dir))


@query(
    "crawl_doc_ids",
    f"""SELECT host, doc_no, 'doc' || doc_no AS doc_id, url FROM (
  SELECT regexp_extract(url, '{HOST}', 1) AS host, url,
    row_number() OVER (PARTITION BY regexp_extract(url, '{HOST}', 1) ORDER BY page_id) AS doc_no
  FROM pages)""",
)
def crawl_doc_ids(spark, sf_dir):
    return ln.crawl_doc_ids(b.table(spark, sf_dir, "pages"))


# --- robots ----------------------------------------------------------------------------------


@query(
    "robots_rules", oracle("SELECT host, agent, line_no, path FROM robots_rules", "robots_rules")
)
def robots_rules(spark, sf_dir):
    return rb.robots_rules(b.robots(spark, sf_dir)).withColumn(
        "line_no", F.col("line_no").cast("bigint")
    )


@query(
    "robots_agent_rules",
    oracle(
        """SELECT host, agent, line_no, path FROM robots_rules r WHERE agent =
  CASE WHEN EXISTS (SELECT 1 FROM robots_lines a WHERE a.host = r.host AND a.key = 'user-agent'
                    AND a.value = 'IndexBot') THEN 'IndexBot' ELSE '*' END""",
        "robots_rules",
    ),
)
def robots_agent_rules(spark, sf_dir):
    return rb.robots_rules(b.robots(spark, sf_dir), agent="IndexBot").withColumn(
        "line_no", F.col("line_no").cast("bigint")
    )


@query(
    "robots_allowed",
    oracle(
        f"""SELECT page_id, src_url, url FROM links WHERE NOT EXISTS (
  SELECT 1 FROM robots_rules r WHERE r.agent = '*' AND r.host = regexp_extract(links.url, '{HOST}', 1)
    AND starts_with(links.url, regexp_extract(links.url, '^([^/]*//[^/?#]*)', 1) || r.path))""",
        "links",
        "robots_rules",
    ),
)
def robots_allowed(spark, sf_dir):
    rules = rb.robots_rules(b.robots(spark, sf_dir), agent="*")
    return rb.robots_allowed(b.stored_links(spark, sf_dir), rules)


@query(
    "robots_exact",
    oracle(
        f"""SELECT page_id, src_url, url FROM links WHERE NOT EXISTS (
  SELECT 1 FROM robots_rules r WHERE r.agent = '*' AND r.host = regexp_extract(links.url, '{HOST}', 1)
    AND r.path = regexp_extract(links.url, '{PATH}', 1))""",
        "links",
        "robots_rules",
    ),
)
def robots_exact(spark, sf_dir):
    rules = rb.robots_rules(b.robots(spark, sf_dir), agent="*")
    return rb.robots_allowed(b.stored_links(spark, sf_dir), rules, match="exact")


part(
    "robots_steps",
    """
SELECT *, sum(opens) OVER (PARTITION BY host ORDER BY line_no) AS entry,
  last_value(opener IGNORE NULLS) OVER (PARTITION BY host ORDER BY line_no) AS state
FROM (SELECT *, CASE WHEN key IN ('blank', 'user-agent') THEN key END AS opener,
        CASE WHEN key = 'user-agent' AND coalesce(lag(key) OVER (PARTITION BY host ORDER BY line_no),
          'blank') <> 'user-agent' THEN 1 ELSE 0 END AS opens
      FROM (SELECT host, line_no, CASE WHEN raw = '' THEN 'blank' ELSE key END AS key, value
            FROM robots_lines)
      WHERE key IN ('blank', 'user-agent', 'allow', 'disallow', 'crawl-delay'))""",
    "robots_lines",
)
part("robots_entries", "SELECT * FROM robots_steps WHERE state = 'user-agent'", "robots_steps")
part(
    "robots_choice",
    """
SELECT host, arg_min(entry, (rank, entry)) AS entry FROM (
  SELECT host, entry, CASE
      WHEN bool_or(key = 'user-agent' AND value = '*') THEN 1
      WHEN bool_or(key = 'user-agent' AND contains('indexbot', lower(value))) THEN 0 END AS rank
  FROM robots_entries GROUP BY host, entry
  HAVING bool_or(key IN ('allow', 'disallow', 'crawl-delay')))
WHERE rank IS NOT NULL GROUP BY host""",
    "robots_entries",
)


@query(
    "robots_can_fetch",
    oracle(
        f"""SELECT page_id, url, coalesce((
    SELECT arg_min(e.key = 'allow' OR e.value = '', e.line_no)
    FROM robots_entries e JOIN robots_choice c USING (host, entry)
    WHERE e.host = regexp_extract(links.url, '{HOST}', 1) AND e.key IN ('allow', 'disallow')
      AND starts_with(CASE WHEN regexp_replace(links.url, '^[^/]*//[^/?#]*', '') = '' THEN '/'
        ELSE regexp_replace(links.url, '^[^/]*//[^/?#]*', '') END, e.value)), true) AS can_fetch
FROM links""",
        "links",
        "robots_choice",
    ),
)
def robots_can_fetch(spark, sf_dir):
    found = b.stored_links(spark, sf_dir)
    checked = rb.robots_can_fetch(found, b.robots(spark, sf_dir), "IndexBot/2.1")
    return checked.select("page_id", "url", "can_fetch")


@query(
    "robots_longest",
    oracle(
        f"""SELECT page_id, src_url, url, coalesce(best.allow, true) AS can_fetch, best.path AS rule FROM (
  SELECT page_id, src_url, url, (SELECT arg_max({{'allow': r.allow, 'path': r.path}},
      {{'bytes': strlen(r.path), 'allow': r.allow, 'path': r.path}}) FROM pattern_rules r
    WHERE r.host = regexp_extract(links.url, '{HOST}', 1)
      AND regexp_matches(CASE WHEN regexp_replace(links.url, '^[^/]*//[^/?#]*', '') = '' THEN '/'
        ELSE regexp_replace(links.url, '^[^/]*//[^/?#]*', '') END, r.pattern)) AS best
  FROM links)""",
        "links",
        "pattern_rules",
    ),
)
def robots_longest(spark, sf_dir):
    """Verdict of the longest rule with wildcards on every link."""
    return rb.robots_longest(b.stored_links(spark, sf_dir), b.pattern_robots(spark, sf_dir), "IndexBot")


@query(
    "robots_facts",
    oracle(
        """SELECT host, (SELECT arg_max(CAST(l.value AS DOUBLE), l.line_no) FROM robots_lines l
    WHERE l.host = robots.host AND l.key = 'crawl-delay') AS crawl_delay,
  (SELECT string_agg(l.value, ' ' ORDER BY l.line_no) FROM robots_lines l
    WHERE l.host = robots.host AND l.key = 'sitemap') AS site_maps
FROM robots""",
        "robots_lines",
    ),
)
def robots_facts(spark, sf_dir):
    facts = rb.robots_facts(b.robots(spark, sf_dir), "OtherBot")
    return facts.withColumn("site_maps", F.array_join("site_maps", " "))


# --- frontier --------------------------------------------------------------------------------


@query(
    "frontier_top2",
    oracle(
        """SELECT url, host, priority, seq FROM frontier WHERE priority IN (
  SELECT DISTINCT priority FROM frontier ORDER BY priority LIMIT 2)""",
        "frontier",
    ),
)
def frontier_top2(spark, sf_dir):
    return fr.in_best_priorities(b.stored_frontier(spark, sf_dir)).select("url", "host", "priority", "seq")


@query(
    "frontier_quota",
    oracle(
        """SELECT priority, quota, url, place FROM (
  SELECT priority, url, row_number() OVER (PARTITION BY priority ORDER BY seq, url) AS place
  FROM frontier)
JOIN (SELECT priority, CAST(ceil(round(100 * (1.0::DOUBLE / rank)
          / sum(1.0::DOUBLE / rank) OVER (), 9)) AS BIGINT) AS quota
      FROM (SELECT priority, row_number() OVER (ORDER BY priority) AS rank
            FROM (SELECT DISTINCT priority FROM frontier))) USING (priority)
WHERE place <= quota""",
        "frontier",
    ),
)
def frontier_quota(spark, sf_dir):
    batch = fr.quota_batch(b.stored_frontier(spark, sf_dir), batch=100)
    return batch.select("priority", "quota", "url", "place")


@query(
    "frontier_draw",
    oracle(
        """SELECT row_number() OVER (ORDER BY key, url) AS place, url, host, priority FROM (
  SELECT url, host, priority, -ln((('0x' || substr(md5('draw' || url), 1, 13))::BIGINT::DOUBLE + 0.5)
    / 4503599627370496.0::DOUBLE) * rank * size AS key
  FROM frontier JOIN (SELECT priority, count(*) AS size, row_number() OVER (ORDER BY priority) AS rank
    FROM frontier GROUP BY priority) USING (priority)
  ORDER BY key, url LIMIT 100)""",
        "frontier",
    ),
)
def frontier_draw(spark, sf_dir):
    """A batch of 100 addresses, drawn by the weights of their priorities."""
    return fr.weighted_draw(b.stored_frontier(spark, sf_dir), 100, seed="draw")


def schedule_sql(direction: str) -> str:
    return oracle(
        f"""SELECT host, url, priority, slot,
  strftime(TIMESTAMP '{b.BASE_TIME}' + to_seconds(slot - 1), '{SQL_STAMP}') AS next_time
FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY priority, seq {direction}, url) AS slot
      FROM frontier)""",
        "frontier",
    )


@query("crawl_schedule", schedule_sql("ASC"))
def crawl_schedule(spark, sf_dir):
    slots = fr.crawl_schedule(b.stored_frontier(spark, sf_dir), b.base_time())
    return slots.select("host", "url", "priority", "slot", stamp("next_time"))


@query("crawl_schedule_lifo", schedule_sql("DESC"))
def crawl_schedule_lifo(spark, sf_dir):
    slots = fr.crawl_schedule(b.stored_frontier(spark, sf_dir), b.base_time(), discipline="lifo")
    return slots.select("host", "url", "priority", "slot", stamp("next_time"))


@query(
    "host_schedule",
    oracle(f"SELECT host, strftime(next_time, '{SQL_STAMP}') AS next_time FROM schedule", "schedule"),
)
def host_schedule(spark, sf_dir):
    return b.schedule(spark, sf_dir).select("host", stamp("next_time"))


@query(
    "ready_hosts",
    oracle(
        f"""SELECT host, strftime(next_time, '{SQL_STAMP}') AS next_time FROM schedule
WHERE next_time <= {MIDDLE_TIME}""",
        "schedule",
    ),
)
def ready_hosts(spark, sf_dir):
    ready = fr.ready_hosts(b.schedule(spark, sf_dir), b.middle_time(spark, sf_dir))
    return ready.select("host", stamp("next_time"))


@query(
    "next_host",
    oracle(
        f"""SELECT host, strftime(next_time, '{SQL_STAMP}') AS next_time FROM schedule
ORDER BY schedule.next_time, host LIMIT 1""",
        "schedule",
    ),
)
def next_host(spark, sf_dir):
    return fr.next_host(b.schedule(spark, sf_dir)).select("host", stamp("next_time"))


part(
    "round_crawled",
    "SELECT rtrim(url, '/') AS url FROM pages WHERE starts_with(url, 'http://')",
)
part(
    "round_batch",
    f"""
SELECT f.host, arg_min(url, (priority, seq, url)) AS url, arg_min(priority, (priority, seq, url))
    AS priority
FROM (SELECT * FROM frontier WHERE url NOT IN (SELECT url FROM round_crawled)) f
LEFT JOIN schedule s ON s.host = f.host
WHERE priority IN (SELECT DISTINCT priority FROM frontier
    WHERE url NOT IN (SELECT url FROM round_crawled) ORDER BY priority LIMIT 2)
  AND (s.next_time IS NULL OR s.next_time <= {MIDDLE_TIME})
GROUP BY f.host""",
    "frontier",
    "schedule",
    "round_crawled",
)
part(
    "round_found",
    f"""
SELECT DISTINCT url FROM links
WHERE src_url IN (SELECT url FROM round_batch)
  AND regexp_extract(url, '{HOST}', 1) = regexp_extract(src_url, '{HOST}', 1)
  AND url NOT IN (SELECT url FROM round_crawled) AND url NOT IN (SELECT url FROM round_batch)
  AND url NOT IN (SELECT url FROM frontier)""",
    "links",
    "round_batch",
)


@query(
    "frontier_round",
    oracle(
        f"""SELECT 'fetched' AS kind, url, host, priority, NULL::VARCHAR AS at FROM round_batch
UNION ALL SELECT 'discovered', url, regexp_extract(url, '{HOST}', 1),
  CASE WHEN contains(url, 'news') THEN 1 ELSE 5 END, NULL FROM round_found
UNION ALL SELECT 'schedule', NULL, host, NULL, strftime(max(next_time), '{SQL_STAMP}')
FROM (SELECT host, next_time FROM schedule
      UNION ALL SELECT host, {MIDDLE_TIME} + to_seconds(1) FROM round_batch) GROUP BY host""",
        "round_found",
    ),
)
def frontier_round(spark, sf_dir):
    """One round over all links; plain-http pages count as crawled already."""
    pages = b.linked_pages(spark, sf_dir)
    crawled = b.crawled(spark, sf_dir).where(F.startswith("url", F.lit("http://")))
    result = fr.frontier_round(
        b.stored_frontier(spark, sf_dir),
        pages,
        b.schedule(spark, sf_dir),
        crawled,
        b.middle_time(spark, sf_dir),
    )
    none = F.lit(None)
    fetched = result.fetched.select(
        F.lit("fetched").alias("kind"), "url", "host", "priority", none.cast("string").alias("at")
    )
    discovered = result.discovered.select(
        F.lit("discovered").alias("kind"), "url", "host", "priority", none.alias("at")
    )
    schedule = result.schedule.select(
        F.lit("schedule").alias("kind"),
        none.alias("url"),
        "host",
        none.alias("priority"),
        F.date_format("next_time", STAMP).alias("at"),
    )
    return fetched.union(discovered).union(schedule)


ROUNDS = 6
# Every round's batch and what it finds, one after the other.
for _n in range(ROUNDS):
    _known = "(SELECT host, url, priority, seq FROM frontier" + "".join(
        f" UNION ALL SELECT host, url, priority, seq FROM crawl_found_{m}" for m in range(_n)
    ) + ")"
    _done = "".join(f" AND k.url NOT IN (SELECT url FROM crawl_batch_{m})" for m in range(_n))
    _times = "(SELECT host, next_time FROM schedule" + "".join(
        f" UNION ALL SELECT host, {MIDDLE_TIME} + to_seconds({m + 1}) FROM crawl_batch_{m}" for m in range(_n)
    ) + ")"
    _before = [f"crawl_{kind}_{m}" for m in range(_n) for kind in ("batch", "found")]
    part(
        f"crawl_batch_{_n}",
        f"""
SELECT k.host, unnest(min(row(k.priority, k.seq, k.url)), max_depth := 2), any_value(t.next_time) AS ready
FROM {_known} k(host, url, priority, seq)
LEFT JOIN (SELECT host, max(next_time) AS next_time FROM {_times} GROUP BY host) t ON t.host = k.host
WHERE (t.next_time IS NULL OR t.next_time <= {MIDDLE_TIME} + to_seconds({_n})){_done}
GROUP BY k.host""".replace("unnest(min(row(k.priority, k.seq, k.url)), max_depth := 2)",
            "min({'p': k.priority, 's': k.seq, 'u': k.url}).p AS priority, min({'p': k.priority, 's': k.seq, 'u': k.url}).u AS url"),
        "frontier",
        "schedule",
        *_before,
    )
    part(
        f"crawl_found_{_n}",
        f"""
SELECT DISTINCT regexp_extract(url, '{HOST}', 1) AS host, url,
  CASE WHEN contains(url, 'news') THEN 1 ELSE 5 END AS priority,
  (SELECT max(seq) FROM frontier) + 1 + {_n} AS seq
FROM links WHERE src_url IN (SELECT url FROM crawl_batch_{_n})
  AND regexp_extract(url, '{HOST}', 1) = regexp_extract(src_url, '{HOST}', 1)
  AND url NOT IN (SELECT k.url FROM {_known} k(host, url, priority, seq))""",
        "links",
        "frontier",
        f"crawl_batch_{_n}",
        *_before,
    )


@query(
    "crawl_rounds",
    oracle(
        " UNION ALL ".join(
            f"""SELECT {n} AS round, 'visit' AS kind, host, url, priority::INTEGER AS priority FROM crawl_batch_{n}
UNION ALL SELECT {n}, 'found', host, url, priority FROM crawl_found_{n}"""
            for n in range(ROUNDS)
        ),
        *[f"crawl_{kind}_{n}" for n in range(ROUNDS) for kind in ("batch", "found")],
    ),
)
def crawl_rounds(spark, sf_dir):
    """Six rounds over the links of all pages: what each fetches and what it puts into the frontier."""
    start = b.stored_frontier(spark, sf_dir)
    edges = b.stored_links(spark, sf_dir)
    crawl = fr.crawl_rounds(start, edges, b.schedule(spark, sf_dir), b.middle_time(spark, sf_dir), ROUNDS)
    last = start.select(F.max("seq")).scalar()
    found = crawl.frontier.select(
        (F.col("seq") - last - 1).cast("int").alias("round"), F.lit("found").alias("kind"), "host", "url", "priority"
    ).where("round >= 0")
    visits = crawl.visits.select("round", F.lit("visit").alias("kind"), "host", "url", "priority")
    return visits.unionByName(found)


part(
    "closure_edges",
    f"""
SELECT DISTINCT rtrim(src_url, '/') AS src_url, url FROM links WHERE NOT EXISTS (
  SELECT 1 FROM robots_rules r WHERE r.agent = 'IndexBot'
    AND r.host = regexp_extract(links.url, '{HOST}', 1)
    AND starts_with(links.url, regexp_extract(links.url, '^([^/]*//[^/?#]*)', 1) || r.path))""",
    "links",
    "robots_rules",
)
part(
    "reached",
    """
SELECT rtrim(url, '/') AS url, 0 AS depth FROM pages WHERE page_id = (SELECT min(page_id) FROM pages)
UNION SELECT e.url, depth + 1 FROM reached JOIN closure_edges e ON e.src_url = reached.url
WHERE depth < 30""",
    "closure_edges",
)


@query(
    "crawl_closure",
    oracle("SELECT url, min(depth) AS depth FROM reached GROUP BY url", "reached"),
)
def crawl_closure(spark, sf_dir):
    """Everything the first page leads to, over links that robots rules allow, across hosts."""
    found = b.stored_links(spark, sf_dir)
    rules = rb.robots_rules(b.robots(spark, sf_dir), agent="IndexBot")
    edges = rb.robots_allowed(found, rules).withColumn("src_url", urls.normalize(F.col("src_url")))
    pages = b.table(spark, sf_dir, "pages")
    seeds = pages.orderBy("page_id").limit(1).select(urls.normalize(F.col("url")).alias("url"))
    return fr.crawl_closure(seeds, edges)
