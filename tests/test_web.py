from collections import Counter
from datetime import datetime, timedelta
from hashlib import md5
from math import log
from urllib.robotparser import RobotFileParser

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from webloom.operators import frontier as fr
from webloom.operators import links as ln
from webloom.operators import robots as rb
from webloom.operators.robots_index import prefix_chains
from webloom.session import cut_lineage_by

PAGES = [
    (1, "http://a.com/", '<a href="/x/">x</a><a href="/x">again</a><a href="http://b.com/news">b</a>'
        '<a href="mailto:q@a.com">m</a><a href="/f.pdf">f</a>'),
    (2, "http://a.com/x", '<a href="/">home</a><a href="y?z=1">y</a>'),
    (3, "http://b.com/news", ""),
    (4, "http://b.com/old", None),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string")


def test_page_scan_skips_failures(pages):
    assert rows(ln.page_scan(pages), "page_id") == [(1,), (2,)]


def test_links(pages):
    assert rows(ln.extract_links(pages), "page_id", "url") == [
        (1, "http://a.com/x"), (1, "http://b.com/news"), (2, "http://a.com"), (2, "http://a.com/y?z=1"),
    ]
    loose = rows(ln.extract_links(pages, skip_binary=False), "page_id", "url")
    assert (1, "http://a.com/f.pdf") in loose


def test_domain_filters(spark, pages):
    found = ln.extract_links(pages)
    assert len(rows(ln.same_domain(found))) == 3
    assert rows(ln.same_domain(found, "https://b.com/seed"), "url") == [("http://b.com/news",)]
    seeds = spark.createDataFrame([("http://b.com/1",), ("http://b.com/2",)], "url string")
    for min_rows in (1, 1000):
        assert rows(ln.on_seed_hosts(found, seeds, min_rows=min_rows), "url") == [("http://b.com/news",)]


def test_frontier_sets(spark, pages):
    found = ln.extract_links(pages)
    crawled = spark.createDataFrame([("http://a.com/x",), ("http://a.com",)], "url string")
    assert rows(ln.new_links(found, crawled)) == [("http://a.com/y?z=1",), ("http://b.com/news",)]
    assert len(rows(ln.url_index(crawled, found))) == 4


def test_document_numbers_go_on(spark, pages):
    existing = spark.createDataFrame([("a.com", 7)], "host string, n bigint")
    found = rows(ln.crawl_doc_ids(pages, existing=existing), "host", "doc_no", "url")
    assert found == [
        ("a.com", 8, "http://a.com/"), ("a.com", 9, "http://a.com/x"),
        ("b.com", 1, "http://b.com/news"), ("b.com", 2, "http://b.com/old"),
    ]


# --- robots ----------------------------------------------------------------------------------

ROBOTS = {
    "plain.dk": "User-agent: *\nDisallow: /bin/\nDisallow: /CMS/\n\nSitemap: https://plain.dk/sitemap.xml",
    "mixed.dk": "User-agent: A\nDisallow: /\n\nUser-Agent: B\nDisallow: /b\n\nUser-agent: *\n"
                "Disallow: /kgf\nDisallow: /x*/y$\nCrawl-delay: 3",
    "full.dk": "# comment\nSitemap: https://full.dk/1.xml\nuser-agent: A # me\nUser-agent: B\nAllow: /open\n"
               "Disallow: /\nCrawl-delay: 10\n\nUser-agent: *\nDisallow:\n\nsitemap: https://full.dk/2.xml\n"
               "User-agent: C\nDisallow: /c:d\nDisallow: /%7Euser/",
    "reset.dk": "User-agent: A\nDisallow: /one\nUser-agent: *\nDisallow: /star\nUser-agent: A\nDisallow: /two",
    "void.dk": "Disallow: /early\n\nUser-agent: A\n\nDisallow: /late\nUser-agent: *\nDisallow: /all",
    "empty.dk": "",
    "odd.dk": "User-agent: *\nDisallow: rel/\nDisallow: /a/../b/",
}


@pytest.fixture(scope="module")
def robots(spark):
    return spark.createDataFrame(list(ROBOTS.items()), "host string, robots_txt string")


def rules_of(df, host):
    return [(r.agent, r.path) for r in df.where(F.col("host") == host).orderBy("line_no", "agent").collect()]


def test_rules(robots):
    rules = rb.robots_rules(robots)
    assert rules_of(rules, "plain.dk") == [("*", "/bin/"), ("*", "/CMS/")]
    assert rules_of(rules, "mixed.dk") == [("A", "/"), ("B", "/b"), ("*", "/kgf"), ("*", "/x*/y$")]
    assert rules_of(rules, "full.dk") == [("B", "/"), ("C", "/c:d"), ("C", "/%7Euser/")]
    assert rules_of(rules, "reset.dk") == [("*", "/star"), ("A", "/two")]


def test_rules_strict(robots):
    rules = rb.robots_rules(robots, strict_keys=True)
    # The agent line in other letter case is not seen; its rule falls to the agent above.
    assert rules_of(rules, "mixed.dk") == [("A", "/"), ("A", "/b"), ("*", "/kgf"), ("*", "/x*/y$")]
    assert ("C", "/c") in rules_of(rules, "full.dk")


def test_rules_grouped(robots):
    rules = rb.robots_rules(robots, group_agents=True)
    assert rules_of(rules, "full.dk")[:2] == [("A", "/"), ("B", "/")]
    assert rules_of(rules, "reset.dk") == [("A", "/one"), ("*", "/star"), ("A", "/two")]


def test_rules_of_one_agent(robots):
    rules = rb.robots_rules(robots, agent="A")
    assert rules_of(rules, "mixed.dk") == [("A", "/")]
    assert rules_of(rules, "plain.dk") == [("*", "/bin/"), ("*", "/CMS/")]


LINKS = [
    "http://plain.dk/bin/x", "http://plain.dk/news", "http://plain.dk/bin", "http://mixed.dk/kgf",
    "http://mixed.dk/kgfs", "http://mixed.dk/xaa/y", "http://mixed.dk/xaa/yz", "http://other.dk/bin/",
    "https://full.dk/open/1", "https://full.dk/closed", "http://full.dk/c:d?e=1", "http://full.dk/~user/a",
    "http://full.dk/%7euser/a", "http://reset.dk/one", "http://reset.dk/two", "http://reset.dk/star",
    "http://void.dk/early", "http://void.dk/late", "http://void.dk/all", "http://empty.dk", "http://void.dk", "http://odd.dk/rel/x", "http://odd.dk/b/1",
]


@pytest.fixture(scope="module")
def link_table(spark):
    return spark.createDataFrame([(u,) for u in LINKS], "url string")


@pytest.mark.parametrize("min_rows", [1, 1000])
def test_allowed(spark, robots, link_table, min_rows):
    rules = rb.robots_rules(robots, agent="*")
    allowed = {u for (u,) in rows(rb.robots_allowed(link_table, rules, min_rows=min_rows))}
    assert set(LINKS) - allowed == {
        "http://plain.dk/bin/x", "http://mixed.dk/kgf", "http://mixed.dk/kgfs", "http://reset.dk/star",
        "http://void.dk/all", "http://odd.dk/b/1",
    }
    # A relative rule means the folder of the address itself.
    below = spark.createDataFrame([("http://odd.dk/rel/rel/x",)], "url string")
    assert rows(rb.robots_allowed(below, rules)) == [("http://odd.dk/rel/rel/x",)]
    exact = {u for (u,) in rows(rb.robots_allowed(link_table, rules, match="exact"))}
    assert set(LINKS) - exact == {"http://mixed.dk/kgf", "http://reset.dk/star", "http://void.dk/all"}
    wild = {u for (u,) in rows(rb.robots_allowed(link_table, rules, wildcards=True))}
    assert "http://mixed.dk/xaa/y" not in wild and "http://mixed.dk/xaa/yz" in wild
    with pytest.raises(ValueError):
        rb.robots_allowed(link_table, rules, match="other")


@pytest.mark.parametrize("agent", ["A", "B/1.0", "CrawlerC", "Nobody"])
def test_facts_agree_with_standard_parser(robots, link_table, agent):
    parsers = {}
    for host, text in ROBOTS.items():
        parsers[host] = RobotFileParser()
        parsers[host].parse(text.splitlines())
    checked = rb.robots_can_fetch(link_table, robots, agent, min_rows=1)
    found = {r.url: r.can_fetch for r in checked.collect()}
    hosts = {u: u.split("/")[2] for u in LINKS}
    expected = {u: parsers[h].can_fetch(agent, u) if h in parsers else True for u, h in hosts.items()}
    assert found == expected
    facts = {r.host: (r.crawl_delay, r.site_maps) for r in rb.robots_facts(robots, agent).collect()}
    assert facts == {h: (p.crawl_delay(agent), p.site_maps()) for h, p in parsers.items()}


def wildcard_regex(path):
    body = ".*".join(re.escape(piece) for piece in path.removesuffix("$").split("*"))
    return re.compile(body + ("$" if path.endswith("$") else ""), re.DOTALL)


WILD = [
    "/", "/a", "/a*", "/a*b", "/*b$", "*", "*$", "$", "/$", "/a$b", "/ab*ab$", "/a**c", "/*/c$", "/é*é", "/a.c", "/a*$",
    "/ab", "/abc", "/abd*", "b", "*b*a*b$",
]


def test_patterns_agree_with_regular_expressions(spark):
    targets = ["/" + "".join(t) for n in range(4) for t in itertools.product("abc.é/", repeat=n)]
    hosts = {f"h{n}.dk": path for n, path in enumerate(WILD)}
    links = spark.createDataFrame([(f"http://{h}{t}",) for h in hosts for t in targets] + [(None,)], "url string")
    rules = spark.createDataFrame(
        [(h, "*", 0, p) for h, p in hosts.items()], "host string, agent string, line_no int, path string"
    )
    kept = {u for (u,) in rb.robots_allowed(links, rules, wildcards=True).collect()}
    free = {f"http://{h}{t}" for h, p in hosts.items() for t in targets if not wildcard_regex(p).match(t)}
    assert kept == {None} | free


def test_longest_rule_decides(spark):
    lines = [("Allow" if len(p) % 2 else "Disallow", p) for p in WILD]
    text = "User-agent: *\n" + "\n".join(f"{key}: {path}" for key, path in lines)
    robots = spark.createDataFrame([("h.dk", text), ("e.dk", "")], "host string, robots_txt string")
    targets = ["/" + "".join(t) for n in range(4) for t in itertools.product("abc.é/", repeat=n)]
    found = [("http://h.dk" + t, i) for i, t in enumerate(targets)]
    links = spark.createDataFrame([*found, found[0], ("http://e.dk/", 1), (None, 2)], "url string, _index int")
    got = rb.robots_longest(links.drop("_index"), robots, "Any").collect()
    assert len(got) == len(found) + 3
    verdicts = {r.url: (r.can_fetch, r.rule) for r in got}
    assert verdicts[None] == verdicts["http://e.dk/"] == (True, None)
    for target in targets:
        fits = [(len(p.encode()), k == "Allow", p) for k, p in lines if wildcard_regex(p).match(target)]
        best = max(fits, default=(0, True, None))
        assert verdicts["http://h.dk" + target] == best[1:], target


def test_host_with_fifty_thousand_rules(spark):
    paths = [f"/{n % 700}/{n:x}{'/' if n % 3 else ''}" for n in range(50_000)]
    rules = spark.createDataFrame([("big.dk", "*", n, p) for n, p in enumerate(paths)], "host string, agent string, line_no int, path string")
    targets = [p + tail for p in paths[::25] for tail in ("", "x", "/y")] + [f"/{n}/zz" for n in range(700)]
    links = spark.createDataFrame([("http://big.dk" + t,) for t in targets], "url string")
    known = set(paths)
    cuts = {t: any(t[:n] in known for n in range(1, len(t) + 1)) for t in targets}
    kept = sorted(u for (u,) in rb.robots_allowed(links, rules).collect())
    assert kept == sorted("http://big.dk" + t for t in targets if not cuts[t])
    exact = sorted(u for (u,) in rb.robots_allowed(links, rules, match="exact").collect())
    assert exact == sorted("http://big.dk" + t for t in targets if t not in known)


def test_prefix_chains():
    assert prefix_chains(["", "/a", "/a/b", "/a/c", "/b"]) == [[0], [0, 1], [0, 1, 2], [0, 1, 3], [0, 4]]
    assert prefix_chains([]) == []


# --- frontier --------------------------------------------------------------------------------

START = datetime(2024, 1, 1)
FRONTIER = [
    ("http://a.com/1", "a.com", 5, 1), ("http://a.com/news", "a.com", 1, 4), ("http://a.com/2", "a.com", 5, 2),
    ("http://b.com/1", "b.com", 3, 3), ("http://b.com/2", "b.com", 5, 5), ("http://c.com/1", "c.com", 9, 6),
]


@pytest.fixture(scope="module")
def frontier(spark):
    return spark.createDataFrame(FRONTIER, "url string, host string, priority int, seq bigint")


def at(seconds):
    return F.lit(START + timedelta(seconds=seconds)).cast("timestamp_ntz")


def test_frontier_of_links(spark):
    found = spark.createDataFrame(
        [("http://a.com/news", 5), ("http://a.com/news", 2), ("nohost", 1)], "url string, seq bigint"
    )
    assert rows(fr.to_frontier(found)) == [("http://a.com/news", "a.com", 1, 2)]


def test_best_priorities(frontier):
    assert rows(fr.in_best_priorities(frontier), "url") == [("http://a.com/news",), ("http://b.com/1",)]


def test_quotas(frontier):
    # Weights 1, 1/2, 1/3, 1/4 of 25/12.
    assert rows(fr.priority_quotas(frontier, 4)) == [(1, 2), (3, 1), (5, 1), (9, 1)]
    batch = rows(fr.quota_batch(frontier, 4), "priority", "url")
    assert batch == [(1, "http://a.com/news"), (3, "http://b.com/1"), (5, "http://a.com/1"), (9, "http://c.com/1")]


def test_schedule_orders(frontier):
    slots = fr.crawl_schedule(frontier, at(0), wait=2)
    found = {(r.host, r.url[-1]): (r.slot, (r.next_time - START).seconds) for r in slots.collect()}
    assert found[("a.com", "s")] == (1, 0) and found[("a.com", "1")] == (2, 2) and found[("a.com", "2")] == (3, 4)
    newest = {r.url: r.slot for r in fr.crawl_schedule(frontier, at(0), discipline="lifo").collect()}
    assert newest["http://a.com/news"] == 1 and newest["http://a.com/2"] == 2 and newest["http://a.com/1"] == 3
    with pytest.raises(ValueError):
        fr.crawl_schedule(frontier, at(0), discipline="random")


def test_host_schedule(spark):
    visits = spark.createDataFrame(
        [("a", START), ("a", START + timedelta(seconds=9)), ("b", START + timedelta(seconds=3))],
        "host string, visited timestamp_ntz",
    )
    schedule = fr.host_schedule(visits)
    assert dict(rows(schedule)) == {"a": START + timedelta(seconds=10), "b": START + timedelta(seconds=4)}
    assert rows(fr.ready_hosts(schedule, at(4)), "host") == [("b",)]
    assert fr.next_host(schedule).first().host == "b"


def test_round(spark, frontier, pages):
    schedule = spark.createDataFrame([("b.com", START + timedelta(hours=1))], "host string, next_time timestamp_ntz")
    own = pages.unionByName(
        spark.createDataFrame(
            [(9, "http://a.com/news", '<a href="/fresh">n</a><a href="/1">known</a><a href="http://c.com/z">o</a>')],
            pages.schema,
        )
    )
    crawled = spark.createDataFrame([("http://a.com/2",)], "url string")
    result = fr.frontier_round(frontier, own, schedule, crawled, at(60))
    assert rows(result.fetched, "url") == [("http://a.com/news",)]
    assert rows(result.discovered) == [("http://a.com/fresh", "a.com", 5)]
    times = dict(rows(result.schedule))
    assert times == {"a.com": START + timedelta(seconds=61), "b.com": START + timedelta(hours=1)}
    open_domain = fr.frontier_round(frontier, own, schedule, crawled, at(60), same_domain_only=False)
    assert len(rows(open_domain.discovered)) == 2


def test_closure_against_brute_force(spark):
    n = 60
    edges = [(f"u{i}", f"u{(i * 7 + k) % n}") for i in range(n) for k in range(2) if i % 5]
    reached, frontier_now, depth = {"u1": 0}, ["u1"], 0
    while frontier_now:
        depth += 1
        step = {d for s, d in edges if s in frontier_now} - set(reached)
        reached.update(dict.fromkeys(step, depth))
        frontier_now = list(step)
    seeds = spark.createDataFrame([("u1",)], "url string")
    table = spark.createDataFrame(edges, "src_url string, url string")
    assert dict(rows(fr.crawl_closure(seeds, table))) == reached
    near = {u: d for u, d in reached.items() if d <= 2}
    assert dict(rows(fr.crawl_closure(seeds, table, max_depth=2))) == near


def test_rounds_of_the_closure_keep_their_layout(spark):
    parts = [cut_lineage_by(spark.range(n, n + 50).select(F.col("id").alias("url")), ["url"]) for n in (0, 50)]
    seen = parts[0].unionByName(parts[1]).hint("merge")
    fresh = spark.range(80, 120).select(F.col("id").alias("url")).join(seen, "url", "left_anti")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert rows(fresh) == [(n,) for n in range(100, 120)]


def test_layers_stay_few_and_keep_their_layout(spark):
    """A chain of 64 rounds: rows read for the seen addresses, and the parts that they lie in."""
    first = cut_lineage_by(spark.range(1).select(F.col("id").alias("url")), ["url"])
    layers = fr.Layers(["url"], first)
    for n in range(1, 64):
        layers.add(cut_lineage_by(spark.range(n, n + 1).select(F.col("id").alias("url")), ["url"]))
        assert len(layers.parts) == bin(n + 1).count("1")
    assert rows(layers.table()) == sorted(((n,) for n in range(64)), key=str)
    layers.add(first)
    fresh = spark.range(60, 70).select(F.col("id").alias("url")).join(layers.table().hint("merge"), "url", "left_anti")
    assert fresh._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_closure_of_a_long_chain(spark):
    chain = spark.createDataFrame([(f"u{n}", f"u{n + 1}") for n in range(20)], "src_url string, url string")
    seeds = spark.createDataFrame([("u0",)], "url string")
    assert dict(rows(fr.crawl_closure(seeds, chain))) == {f"u{n}": n for n in range(21)}


def test_crawl_rounds_against_a_loop(spark):
    rng = random.Random(7)
    pages = [f"http://h{h}.com/{'news' if p % 3 == 0 else 'page'}{p}" for h in range(4) for p in range(12)]
    edges = [(s, rng.choice(pages)) for s in pages for _ in range(3)]
    begin = [(u, u.split("/")[2], 1 if "news" in u else 5, n) for n, u in enumerate(pages[::9])]
    plan = {"h1.com": START + timedelta(seconds=3)}
    known, times, done, visits = {u: (p, s, u) for u, _, p, s in begin}, dict(plan), set(), []
    for number in range(8):
        now = START + timedelta(seconds=number)
        heads = {}
        for u, order in known.items():
            host = u.split("/")[2]
            if u not in done and times.get(host, now) <= now and order < heads.get(host, (9, 0, "")):
                heads[host] = order
        for host, (_, _, u) in heads.items():
            visits.append((number, host, u))
            done.add(u)
            times[host] = now + timedelta(seconds=1)
        for _, _, u in heads.values():
            for s, d in edges:
                if s == u and d.split("/")[2] == u.split("/")[2] and d not in known:
                    known[d] = (1 if "news" in d else 5, len(pages[::9]) + number, d)
    crawl = fr.crawl_rounds(
        spark.createDataFrame(begin, "url string, host string, priority int, seq bigint"),
        spark.createDataFrame(edges, "src_url string, url string"),
        spark.createDataFrame(list(plan.items()), "host string, next_time timestamp"),
        F.lit(START),
        8,
        wait=1,
    )
    assert rows(crawl.visits, "round", "host", "url") == sorted(visits, key=str)
    assert rows(crawl.frontier, "url") == sorted(((u,) for u in known), key=str)
    assert dict(rows(crawl.schedule)) == times


def test_draw_follows_the_weights(spark):
    """First draws over many seeds: priorities as 1/rank, addresses of one priority alike."""
    urls_ = [(f"http://h.com/{p}/{n}", "h.com", p, n) for p, size in ((1, 5), (5, 40), (9, 2)) for n in range(size)]
    frontier = spark.createDataFrame(urls_, "url string, host string, priority int, seq bigint")
    keyed = [fr.draw_key(frontier, str(seed)).collect() for seed in range(2)]
    assert [r["key"] for r in keyed[0]] != [r["key"] for r in keyed[1]]
    sizes, rank = {1: 5, 5: 40, 9: 2}, {1: 1, 5: 2, 9: 3}
    first = Counter()
    for seed in range(4000):
        key = {}
        for url, _, p, _ in urls_:
            unit = (int(md5(f"{seed}{url}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            key[url] = (-log(unit) * rank[p] * sizes[p], p)
        if seed < 2:
            assert {r["url"]: r["key"] for r in keyed[seed]} == pytest.approx({u: k for u, (k, _) in key.items()})
        first[min(key.values())[1]] += 1
    total = 1 + 1 / 2 + 1 / 3
    for p in sizes:
        assert first[p] / 4000 == pytest.approx(1 / rank[p] / total, abs=0.03)
    drawn = fr.weighted_draw(frontier, 12, "7").collect()
    assert [r["place"] for r in sorted(drawn)] == list(range(1, 13)) and len({r["url"] for r in drawn}) == 12
