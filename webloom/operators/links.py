"""Pages to documents and link tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import html as html_fn
from webloom.functions import urls
from webloom.operators.skew import join_skewed, numbered


def page_scan(pages: DataFrame) -> DataFrame:
    """Fetched pages: rows without content count as failed fetches and are skipped."""
    return pages.where(F.col("html").isNotNull() & (F.col("html") != ""))


def page_text(pages: DataFrame, include_scripts: bool = False) -> DataFrame:
    """``(page_id, url, text)`` of every fetched page."""
    visible = html_fn.page_text(F.col("html"), include_scripts)
    return page_scan(pages).select("page_id", "url", visible.alias("text"))


def anchors(pages: DataFrame) -> DataFrame:
    """Raw anchors ``(page_id, src_url, pos, href)`` in page order."""
    hrefs = html_fn.anchor_hrefs(F.col("html"))
    return _one_row_each(page_scan(pages), hrefs, "href")


def extract_links(pages: DataFrame, skip_binary: bool = True) -> DataFrame:
    """Followable links of each page, absolute, normalised, each once: ``(page_id, src_url, url)``.

    De-duplication happens inside the page row, so links cost no shuffle.
    """
    hrefs = F.filter(
        html_fn.anchor_hrefs(F.col("html")), lambda h: urls.is_page_link(h, skip_binary)
    )
    absolute = F.array_distinct(
        F.transform(hrefs, lambda h: urls.normalize(urls.resolve_from(F.col("_base"), h)))
    )
    based = page_scan(pages).withColumn("_base", urls.base_parts(F.col("url")))
    return _one_row_each(based, absolute, "_link").withColumnRenamed("_link", "url")


def _one_row_each(pages: DataFrame, values: Column, name: str) -> DataFrame:
    """Array elements as rows. The outer form keeps the optimizer from parsing every page a second
    time in a filter on the array size."""
    rows = pages.select(
        "page_id", F.col("url").alias("src_url"), F.posexplode_outer(values).alias("pos", name)
    )
    return rows.where(F.col(name).isNotNull())


def same_domain(links: DataFrame, seed_url: str | None = None) -> DataFrame:
    """Links that stay on one host: that of ``seed_url``, or else that of the page they are on."""
    home = urls.host(F.lit(seed_url)) if seed_url else urls.host(F.col("src_url"))
    return links.where(urls.host(F.col("url")).eqNullSafe(home))


def on_seed_hosts(links: DataFrame, seeds: DataFrame, **skew_options) -> DataFrame:
    """Links to any host of a seed table ``(url)``."""
    hosts = seeds.select(urls.host(F.col("url")).alias("_host")).distinct()
    hosted = links.withColumn("_host", urls.host(F.col("url")))
    return join_skewed(hosted, hosts, ["_host"], "left_semi", **skew_options).drop("_host")


def new_links(links: DataFrame, crawled: DataFrame) -> DataFrame:
    """Distinct link targets not crawled yet. Repeated targets collapse before the join."""
    return links.select("url").distinct().join(crawled.select("url"), "url", "left_anti")


def url_index(crawled: DataFrame, links: DataFrame) -> DataFrame:
    """All known addresses: crawled or found."""
    return crawled.select("url").unionByName(links.select("url")).distinct()


def crawl_doc_ids(
    pages: DataFrame, seq: str = "page_id", existing: DataFrame | None = None, **options
) -> DataFrame:
    """Number the documents of each host in crawl order: ``(host, doc_no, doc_id, url)``.

    ``existing`` ``(host, n)`` holds how many documents a host has already.
    """
    hosted = pages.select(urls.host(F.col("url")).alias("host"), "url", seq)
    counted = numbered(hosted, [seq, "url"], "doc_no", ["host"], **options)
    if existing is not None:
        counted = (
            join_skewed(counted, existing, ["host"], "left")
            .withColumn("doc_no", F.col("doc_no") + F.coalesce("n", F.lit(0)))
            .drop("n")
        )
    doc_id = F.concat(F.lit("doc"), F.col("doc_no").cast("string"))
    return counted.select("host", "doc_no", doc_id.alias("doc_id"), "url")
