"""Crawl frontier as tables: priorities, quotas, politeness schedule, rounds and closure.

A frontier is ``(url, host, priority, seq)``, a schedule ``(host, next_time)``. Times are columns
and the current time is a parameter, never the clock.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import urls
from webloom.functions.fixed_values import POLITENESS_SECONDS, PRIORITY_KEYWORD
from webloom.operators.links import extract_links, same_domain
from webloom.operators.skew import HOT_ROWS, join_skewed, numbered
from webloom.session import cut_lineage_by, cut_lineage_in_place


def to_frontier(links: DataFrame, seq: str = "seq", keyword: str = PRIORITY_KEYWORD) -> DataFrame:
    """Frontier of distinct addresses; an address found more than once keeps its first place."""
    first = links.where(urls.host(F.col("url")).isNotNull()).groupBy("url")
    return first.agg(F.min(seq).alias("seq")).select(
        "url",
        urls.host(F.col("url")).alias("host"),
        urls.priority(F.col("url"), keyword).alias("priority"),
        "seq",
    )


def best_priorities(frontier: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` best priorities that still have addresses."""
    return frontier.select("priority").distinct().orderBy("priority").limit(n)


def in_best_priorities(frontier: DataFrame, n: int = 2) -> DataFrame:
    """Addresses of the ``n`` best non-empty priorities. The list has ``n`` rows at most."""
    return frontier.join(F.broadcast(best_priorities(frontier, n)), "priority", "left_semi")


def priority_quotas(frontier: DataFrame, batch: int) -> DataFrame:
    """``(priority, quota)``: a batch shared out by weight 1/rank, rank 1 being the best priority.
    Quotas are rounded up."""
    ranked = numbered(frontier.select("priority").distinct(), ["priority"], "rank")
    weights = ranked.select("priority", (F.lit(1.0) / F.col("rank")).alias("weight"))
    share = F.col("weight") / weights.select(F.sum("weight")).scalar()
    return weights.select("priority", F.ceil(F.round(share * batch, 9)).alias("quota"))


def quota_batch(frontier: DataFrame, batch: int, **options) -> DataFrame:
    """The oldest addresses of each priority up to its quota."""
    placed = numbered(frontier, ["seq", "url"], "place", ["priority"], **options)
    # No place beyond the batch can be within a quota, so the join sees a small part of the rows.
    first = placed.where(F.col("place") <= batch)
    return first.join(priority_quotas(frontier, batch), "priority").where("place <= quota")


def draw_key(frontier: DataFrame, seed: str) -> DataFrame:
    """``frontier`` with the exponential ``key`` of a weighted draw: the smallest keys are drawn.

    A priority of rank r has weight 1/r, shared by its addresses. The key is minus the logarithm of
    a number in (0, 1), a digest of seed and address, over the weight, so it is the same in every run.
    """
    sizes = frontier.groupBy("priority").agg(F.count(F.lit(1)).alias("_size"))
    # One row for each priority; numbered without gathering them in a window over all.
    ranked = numbered(sizes, ["priority"], "_rank")
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(seed), "url")), 1, 13), 16, 10).cast("double")
    unit = (digest + 0.5) / F.lit(float(16**13))
    joined = join_skewed(frontier, ranked, ["priority"])
    return joined.withColumn("key", -F.log(unit) * F.col("_rank") * F.col("_size")).drop("_rank", "_size")


def weighted_draw(frontier: DataFrame, batch: int, seed: str = "0") -> DataFrame:
    """``batch`` addresses of the frontier, drawn without replacement in proportion to their weight,
    in the order of the draw: ``(place, url, host, priority)``. A distributed top-k; the batch is what
    a round fetches, and only that is numbered."""
    drawn = draw_key(frontier, seed).orderBy("key", "url").limit(batch)
    placed = numbered(drawn, ["key", "url"], "place")
    return placed.select("place", "url", "host", "priority")


def crawl_schedule(
    frontier: DataFrame,
    base_time: Column,
    wait: int = POLITENESS_SECONDS,
    discipline: str = "fifo",
    **options,
) -> DataFrame:
    """Give every address a slot: hosts run side by side, one host's addresses ``wait`` seconds apart.

    Order inside a host is priority, then age, oldest first (``fifo``) or newest first (``lifo``).
    """
    if discipline not in ("fifo", "lifo"):
        raise ValueError("discipline must be 'fifo' or 'lifo'")
    sign = 1 if discipline == "fifo" else -1
    ordered = frontier.withColumn("_order", F.col("seq") * sign)
    placed = numbered(ordered, ["priority", "_order", "url"], "slot", ["host"], **options)
    delay = F.make_dt_interval(secs=(F.col("slot") - 1) * wait)
    return placed.select("host", "url", "priority", "slot", (base_time + delay).alias("next_time"))


def host_schedule(visits: DataFrame, wait: int = POLITENESS_SECONDS) -> DataFrame:
    """Latest schedule entry of each host from visits ``(host, visited)``; older ones are void."""
    return visits.groupBy("host").agg(
        (F.max("visited") + F.make_dt_interval(secs=F.lit(wait))).alias("next_time")
    )


def ready_hosts(schedule: DataFrame, now: Column) -> DataFrame:
    return schedule.where(F.col("next_time") <= now)


def next_host(schedule: DataFrame) -> DataFrame:
    """The host that becomes ready first; ties go to the smaller name."""
    return schedule.orderBy("next_time", "host").limit(1)


@dataclass
class Round:
    """Result of one frontier round."""

    fetched: DataFrame  # (url, host, priority, seq)
    discovered: DataFrame  # (url, host, priority)
    schedule: DataFrame  # (host, next_time)


def frontier_round(
    frontier: DataFrame,
    pages: DataFrame,
    schedule: DataFrame,
    crawled: DataFrame,
    now: Column,
    wait: int = POLITENESS_SECONDS,
    keyword: str = PRIORITY_KEYWORD,
    same_domain_only: bool = True,
    min_rows: int = HOT_ROWS,
) -> Round:
    """One crawl round as a table update.

    From the two best priorities every ready host gets one address, its first by priority and age.
    Links of the fetched pages that are new, and on the page's host if ``same_domain_only``, are
    put in with their priority; the visited hosts become ready ``wait`` seconds later. Addresses
    of hosts that are not ready stay in the frontier.
    """
    open_urls = frontier.join(crawled.select("url"), "url", "left_anti")
    eligible = in_best_priorities(open_urls)
    # One candidate for each host before the schedule is looked up.
    first = eligible.groupBy("host").agg(F.min(F.struct("priority", "seq", "url")).alias("pick"))
    batch = (
        first.join(schedule, "host", "left")
        .where(F.col("next_time").isNull() | (F.col("next_time") <= now))
        .select("pick.url", "host", "pick.priority", "pick.seq")
    )
    found = extract_links(pages.join(batch.select("url"), "url", "left_semi"))
    if same_domain_only:
        found = same_domain(found)
    fresh = (
        found.select("url")
        .distinct()
        .join(crawled.select("url").unionByName(batch.select("url")), "url", "left_anti")
        .join(frontier.select("url"), "url", "left_anti")
    )
    discovered = fresh.select(
        "url",
        urls.host(F.col("url")).alias("host"),
        urls.priority(F.col("url"), keyword).alias("priority"),
    )
    visited = batch.select("host", (now + F.make_dt_interval(secs=F.lit(wait))).alias("next_time"))
    updated = (
        schedule.select("host", "next_time")
        .unionByName(visited)
        .groupBy("host")
        .agg(F.max("next_time").alias("next_time"))
    )
    return Round(batch, discovered, updated)


class Layers:
    """A growing table, laid out by ``keys``, in as many parts as its number of additions has binary
    digits set.

    Two parts of one age are merged, so a row is written O(log n) times in n additions and a reader
    sees O(log n) parts. All parts have one layout: neither reading nor merging shuffles.
    """

    def __init__(self, keys: list[str], first: DataFrame):
        self.keys = keys
        self.parts: list[tuple[int, DataFrame]] = [(0, first)]

    def add(self, laid: DataFrame) -> None:
        """Put in a table that ``cut_lineage_by`` has laid out by the keys."""
        self.parts.append((0, laid))
        while len(self.parts) > 1 and self.parts[-1][0] == self.parts[-2][0]:
            (age, newer), (_, older) = self.parts.pop(), self.parts.pop()
            self.parts.append((age + 1, cut_lineage_in_place(older.unionByName(newer))))

    def table(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [part for _, part in self.parts])


def crawl_closure(
    seeds: DataFrame, edges: DataFrame, max_depth: int | None = None
) -> DataFrame:
    """Breadth-first closure of ``seeds (url)`` over ``edges (src_url, url)``: ``(url, depth)``.

    Edges should already be filtered (domain, robots); seeds are taken as they are. Every round
    expands only the addresses first seen in the round before, and reads the earlier ones from
    ``Layers``. Rounds are written to the checkpoint folder, which keeps the plan short and survives
    lost executors. All are laid out by address there, so a round shuffles its own addresses only.
    """
    pairs = edges.select("src_url", "url").distinct()
    # Laid out by source once, so that a round shuffles its own addresses only.
    by_source = cut_lineage_by(pairs, ["src_url"])
    new = cut_lineage_by(seeds.select("url").distinct().withColumn("depth", F.lit(0)), ["url"])
    seen, depth = Layers(["url"], new), 0
    while max_depth is None or depth < max_depth:
        depth += 1
        reached = (
            by_source.join(new.select(F.col("url").alias("src_url")), "src_url", "left_semi")
            .select("url")
            .distinct()
            .join(seen.table().select("url"), "url", "left_anti")
        )
        new = cut_lineage_by(reached.withColumn("depth", F.lit(depth)), ["url"])
        if new.isEmpty():
            break
        seen.add(new)
    return seen.table()


@dataclass
class Crawl:
    """What a crawl of several rounds leaves behind."""

    visits: DataFrame  # (round, host, url, priority, visited)
    frontier: DataFrame  # (host, url, priority, seq): all addresses ever put in
    schedule: DataFrame  # (host, next_time)


def crawl_rounds(
    frontier: DataFrame,
    edges: DataFrame,
    schedule: DataFrame,
    start: Column,
    rounds: int,
    wait: int = POLITENESS_SECONDS,
    keyword: str = PRIORITY_KEYWORD,
) -> Crawl:
    """Drive a crawl from ``start`` over ``rounds`` rounds, ``wait`` seconds apart.

    In each round every host that is ready gives its first open address by priority, age and name.
    The links ``edges (src_url, url)`` of what was fetched that stay on their host and are new are
    put in, aged by the round; the host is ready again ``wait`` seconds later. Hosts that the schedule
    does not know are ready at once; rounds in which nobody is ready pass. The round that finds
    nothing open any more is the last.

    Frontier, visits and schedule are logs in ``Layers``, laid out by host, and the edges are laid out
    by source once. So a round reads the state where it lies and shuffles its own batch and the
    links of that only. Every step is written to the checkpoint folder.
    """
    by_source = cut_lineage_by(
        edges.where(urls.host(F.col("src_url")) == urls.host(F.col("url"))).select("src_url", "url").distinct(),
        ["src_url"],
    )
    known = Layers(["host"], cut_lineage_by(frontier.select("host", "url", "priority", "seq"), ["host"]))
    times = Layers(["host"], cut_lineage_by(schedule.select("host", "next_time"), ["host"]))
    # No address is older than those of the start.
    age = (frontier.select(F.max("seq")).first()[0] or 0) + 1
    none = cut_lineage_by(frontier.select("host", "url", "priority").limit(0), ["host"])
    fetched = Layers(["host"], none)
    visits = []
    for number in range(rounds):
        now = start + F.make_dt_interval(secs=F.lit(number * wait))
        done = fetched.table().select("host", "url", F.lit(None).cast("int").alias("priority"), F.lit(None).cast("bigint").alias("seq"), F.lit(1).alias("done"))
        every = known.table().select("host", "url", F.col("priority").cast("int").alias("priority"), F.col("seq").cast("bigint").alias("seq"), F.lit(0).alias("done"))
        # Addresses of a host lie together, so both groupings stay where the rows are.
        open_urls = every.unionByName(done).groupBy("host", "url").agg(
            F.min("priority").alias("priority"), F.min("seq").alias("seq"), F.max("done").alias("done")
        ).where("done = 0")
        first = open_urls.groupBy("host").agg(F.min(F.struct("priority", "seq", "url")).alias("pick"))
        ready = times.table().groupBy("host").agg(F.max("next_time").alias("next_time"))
        found = first.join(ready, "host", "left").select("host", "pick.url", "pick.priority", "next_time")
        heads = cut_lineage_in_place(found)
        if heads.isEmpty():
            break
        batch = cut_lineage_in_place(
            heads.where(F.col("next_time").isNull() | (F.col("next_time") <= now)).select("host", "url", "priority")
        )
        visits.append(batch.select(F.lit(number).alias("round"), "host", "url", "priority", now.alias("visited")))
        fetched.add(batch)
        times.add(
            cut_lineage_in_place(batch.select("host", (now + F.make_dt_interval(secs=F.lit(wait))).alias("next_time")))
        )
        links = by_source.join(batch.select(F.col("url").alias("src_url")), "src_url", "left_semi").select("url").distinct()
        linked = cut_lineage_by(links.select(urls.host(F.col("url")).alias("host"), "url"), ["host"])
        both = linked.withColumn("old", F.lit(0)).unionByName(known.table().select("host", "url", F.lit(1).alias("old")))
        fresh = both.groupBy("host", "url").agg(F.max("old").alias("old")).where("old = 0")
        known.add(
            cut_lineage_in_place(
                fresh.select(
                    "host",
                    "url",
                    urls.priority(F.col("url"), keyword).alias("priority"),
                    F.lit(age + number).cast("bigint").alias("seq"),
                )
            )
        )
    empty = none.select(F.lit(0).alias("round"), "host", "url", "priority", start.alias("visited"))
    latest = times.table().groupBy("host").agg(F.max("next_time").alias("next_time"))
    return Crawl(reduce(DataFrame.unionByName, [empty, *visits]), known.table(), latest)
