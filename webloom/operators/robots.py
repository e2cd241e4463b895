"""Robots rules: parsing, exclusion joins and crawl facts.

A robots text is one value of one row. Its lines, and the rules made from them, are bounded by
that value, so windows by host and rule lists by host stay small however many pages a host has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions import urls
from webloom.functions.text import strip_space
from webloom.operators.robots_index import fitting, indexed_rules, pattern_head, pattern_tail, tail_fits
from webloom.operators.skew import join_skewed


def robots_lines(robots: DataFrame) -> DataFrame:
    """``(host, line_no, raw, line)``: raw lines, and lines without comment and edge space."""
    lines = robots.select(
        "host", F.posexplode(F.split("robots_txt", r"\r\n|\r|\n")).alias("line_no", "raw")
    )
    return lines.withColumn("line", strip_space(F.split_part("raw", F.lit("#"), F.lit(1))))


def robots_rules(
    robots: DataFrame,
    agent: str | None = None,
    strict_keys: bool = False,
    group_agents: bool = False,
) -> DataFrame:
    """Disallow rules ``(host, agent, line_no, path)``.

    A rule belongs to the latest agent line above it; a repeated agent line starts that agent's
    list anew. ``strict_keys`` knows only ``User-agent:`` and ``Disallow:`` in this spelling, keeps
    comments and cuts paths at a second colon. ``group_agents`` gives a run of agent lines the
    rules below it. ``agent`` keeps the rules of one agent, or those of ``*`` where it has none.
    """
    if strict_keys:
        lines = robots_lines(robots).withColumn("line", strip_space(F.col("raw")))
        key = F.when(F.startswith("line", F.lit("User-agent:")), "user-agent").when(
            F.startswith("line", F.lit("Disallow:")), "disallow"
        )
        value = strip_space(F.split_part("line", F.lit(":"), F.lit(2)))
    else:
        lines = robots_lines(robots)
        key = F.lower(strip_space(F.split_part("line", F.lit(":"), F.lit(1))))
        value = strip_space(F.regexp_extract("line", r"^[^:]*:(.*)$", 1))
    parsed = (
        lines.withColumn("key", F.when(F.col("line").contains(":"), key))
        .withColumn("value", value)
        .where(F.col("key").isin("user-agent", "disallow"))
    )
    by_line = Window.partitionBy("host").orderBy("line_no")
    is_agent = F.col("key") == "user-agent"
    if group_agents:
        opens = is_agent & ~F.lag("key").over(by_line).eqNullSafe(F.lit("user-agent"))
        parsed = parsed.withColumn("block", F.sum(opens.cast("int")).over(by_line))
    else:
        parsed = parsed.withColumn("block", F.sum(is_agent.cast("int")).over(by_line))
    agents = parsed.where(is_agent).select("host", "block", F.col("value").alias("agent"))
    paths = parsed.where((~is_agent) & (F.col("value") != "")).select(
        "host", "block", "line_no", F.col("value").alias("path")
    )
    latest = Window.partitionBy("host", "agent")
    # Without grouping only the last block of a repeated agent counts.
    agents = agents.withColumn("last_block", F.max("block").over(latest))
    if not group_agents:
        agents = agents.where(F.col("block") == F.col("last_block"))
    known = agents.join(paths, ["host", "block"], "left").where(F.col("agent") != "")
    if agent is not None:
        wanted = known.where(F.col("agent").isin(agent, "*"))
        has_own = F.max(F.col("agent") == agent).over(Window.partitionBy("host"))
        known = (
            wanted.withColumn("own", has_own)
            .where(F.col("agent") == F.when(F.col("own"), agent).otherwise("*"))
            .drop("own")
        )
    return known.where(F.col("path").isNotNull()).select("host", "agent", "line_no", "path")


def _rule_lists(rules: DataFrame, match: str, wildcards: bool) -> DataFrame:
    """One row for each host: its rules as ``indexed_rules``, bounded by the robots text they come from.

    A prefix rule is indexed by what the part of an address after the host starts with if the rule
    hits; rules that do not begin with one slash depend on the address and stay in ``_odd``.
    """
    path = F.col("path")
    if match == "exact":
        return indexed_rules(rules, path, path)
    if wildcards:
        return indexed_rules(rules, pattern_head(path), pattern_tail(path))
    rooted = F.startswith(path, F.lit("/")) & ~F.startswith(path, F.lit("//"))
    start = urls.resolve(F.lit("http://h"), path).substr(F.lit(len("http://h") + 1), F.length(path))
    return indexed_rules(rules, F.when(rooted, start), path)


def robots_allowed(
    links: DataFrame,
    rules: DataFrame,
    match: str = "prefix",
    wildcards: bool = False,
    **skew_options,
) -> DataFrame:
    """Links that no rule of their host forbids.

    ``match="prefix"`` forbids addresses that start with a rule path, ``match="exact"`` only the
    path itself; with ``wildcards`` a rule may hold ``*`` for any run and a final ``$`` for the end.
    Rules come as one sorted row for each host, which an address searches by halves; the join never
    multiplies links, and a host with very many links is salted.
    """
    if match not in ("prefix", "exact"):
        raise ValueError("match must be 'prefix' or 'exact'")
    joined = _with_rules(links, _rule_lists(rules, match, wildcards), skew_options)
    url, no = F.col("url"), F.lit(False)
    if match == "exact":
        hit = F.coalesce(F.array_contains(fitting(urls.path(url)), urls.path(url)), no)
    elif wildcards:
        target = urls.path_and_query(url)
        hit = F.coalesce(F.exists(fitting(target), lambda tail: tail_fits(tail, target)), no)
    else:
        below_folder = F.exists("_odd", lambda path: F.startswith(url, urls.resolve(url, path)))
        hit = F.coalesce(F.size(fitting(urls.after_host(url))) > 0, no) | F.coalesce(below_folder, no)
    return joined.where(~hit).select(*links.columns)


# --- facts as a standard robots parser reports them ------------------------------------------

_RULE_KEYS = ("allow", "disallow", "crawl-delay", "request-rate")


def _entries(robots: DataFrame) -> DataFrame:
    """Parsed lines with the entry they belong to: ``(host, line_no, key, value, entry)``.

    An entry opens at an agent line that does not follow another agent line. A blank line closes
    it; rules outside an entry are void.
    """
    line = F.col("line")
    key = F.lower(strip_space(F.split_part(line, F.lit(":"), F.lit(1))))
    value = urls.percent_decoded(strip_space(F.regexp_extract(line, r"^[^:]*:(.*)$", 1)))
    parsed = robots_lines(robots).select(
        "host",
        "line_no",
        F.when(F.col("raw") == "", "blank").when(line.contains(":"), key).alias("key"),
        value.alias("value"),
    )
    steps = parsed.where(F.col("key").isin("blank", "user-agent", *_RULE_KEYS))
    by_line = Window.partitionBy("host").orderBy("line_no")
    is_agent = F.col("key") == "user-agent"
    before = F.coalesce(F.lag("key").over(by_line), F.lit("blank"))
    opener = F.when(F.col("key").isin("blank", "user-agent"), F.col("key"))
    return (
        steps.withColumn("opens", (is_agent & (before != "user-agent")).cast("int"))
        .withColumn("entry", F.sum("opens").over(by_line))
        .withColumn("inside", F.last(opener, ignorenulls=True).over(by_line) == "user-agent")
        .where("inside")
        .select("host", "line_no", "key", "value", "entry")
    )


def _chosen_entries(robots: DataFrame, agent: str) -> DataFrame:
    """Lines of the one entry that speaks for ``agent`` on each host, in line order.

    The first entry that names a part of the agent's name wins, then the first entry for ``*``.
    Entries without rules do not count.
    """
    token = agent.split("/")[0].lower()
    entries = _entries(robots)
    is_agent = F.col("key") == "user-agent"
    named = F.lit(token).contains(F.lower("value"))
    summary = entries.groupBy("host", "entry").agg(
        F.max(F.col("key").isin(*_RULE_KEYS)).alias("has_rules"),
        F.max(is_agent & (F.col("value") == "*")).alias("is_default"),
        F.max(is_agent & named).alias("is_named"),
    )
    rank = F.when(~F.col("is_default") & F.col("is_named"), 0).when(F.col("is_default"), 1)
    chosen = (
        summary.where("has_rules")
        .withColumn("rank", rank)
        .where(F.col("rank").isNotNull())
        .groupBy("host")
        .agg(F.min(F.struct("rank", "entry")).alias("best"))
        .select("host", F.col("best.entry").alias("entry"))
    )
    return entries.join(chosen, ["host", "entry"])


def robots_can_fetch(
    links: DataFrame, robots: DataFrame, agent: str, **skew_options
) -> DataFrame:
    """``links`` with ``can_fetch``: the first rule that fits the address decides, default true."""
    lines = _chosen_entries(robots, agent).where(F.col("key").isin("allow", "disallow"))
    allow = (F.col("key") == "allow") | (F.col("value") == "")
    head = F.when(F.col("value") == "*", F.lit("")).otherwise(F.col("value"))
    listed = indexed_rules(lines, head, F.struct("line_no", allow.alias("allow")))
    target = urls.path_and_query(urls.percent_decoded(F.col("url")))
    joined = _with_rules(links, listed, skew_options)
    verdict = F.coalesce(F.array_min(fitting(target))["allow"], F.lit(True))
    return joined.select(*links.columns, verdict.alias("can_fetch"))


def robots_longest(
    links: DataFrame, robots: DataFrame, agent: str, **skew_options
) -> DataFrame:
    """``links`` with ``can_fetch`` and ``rule``: among the rules that fit, with ``*`` and ``$``, the one
    of most bytes decides; of equally long ones an allowing one, then the greater text. Without a
    fitting rule, a host or an address, ``can_fetch`` is true and ``rule`` null.

    Columns of ``links`` must not be named ``can_fetch`` or ``rule``; repeated links stay as they are.
    """
    lines = _chosen_entries(robots, agent).where(
        F.col("key").isin("allow", "disallow") & (F.col("value") != "")
    )
    path = F.col("value")
    rank = F.struct(
        F.octet_length(path).alias("bytes"),
        (F.col("key") == "allow").alias("allow"),
        path.alias("path"),
    )
    entry = F.struct(rank.alias("rank"), pattern_tail(path).alias("tail"))
    listed = indexed_rules(lines, pattern_head(path), entry)
    target = urls.path_and_query(urls.percent_decoded(F.col("url")))
    fits = F.filter(fitting(target), lambda e: tail_fits(e["tail"], target))
    best = F.array_max(F.transform(fits, lambda e: e["rank"]))
    decided = _with_rules(links, listed, skew_options).withColumn("_best", best)
    return decided.select(
        *links.columns,
        F.coalesce(F.col("_best.allow"), F.lit(True)).alias("can_fetch"),
        F.col("_best.path").alias("rule"),
    )


def _with_rules(links: DataFrame, listed: DataFrame, skew_options: dict) -> DataFrame:
    hosted = links.withColumn("_host", urls.host(F.col("url")))
    return join_skewed(
        hosted, listed.withColumnRenamed("host", "_host"), ["_host"], "left", **skew_options
    )


def robots_facts(robots: DataFrame, agent: str) -> DataFrame:
    """``(host, crawl_delay, site_maps)``: the agent's delay in seconds and all sitemaps in order."""
    delays = (
        _chosen_entries(robots, agent)
        .where((F.col("key") == "crawl-delay") & F.col("value").rlike(r"^\d+$"))
        .groupBy("host")
        .agg(F.max_by("value", "line_no").cast("double").alias("crawl_delay"))
    )
    line = F.col("line")
    site = F.struct(
        "line_no", strip_space(F.regexp_extract(line, r"^[^:]*:(.*)$", 1)).alias("address")
    )
    maps = (
        robots_lines(robots)
        .where(line.rlike(r"^(?i)sitemap\s*:"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(site))["address"].alias("site_maps"))
    )
    return robots.select("host").join(delays, "host", "left").join(maps, "host", "left")
