"""Main text of pages by comparing each page with its neighbour in the order of addresses."""

from __future__ import annotations

import re
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import join_counted, lists_of, map_batches, shared_table
from webloom.operators.skew import numbered

# Elements whose content is never part of an article.
BOILERPLATE = frozenset(
    "nav header footer aside form script style noscript template menu dialog iframe svg button select "
    "textarea option label head title object canvas audio video".split()
)
# Elements whose content is text and not markup up to their end tag.
RAW = frozenset("script style textarea title noscript iframe".split())
# Words that as a whole class, id or role mark menus, notices, adverts, forms and reader comments.
MARKED = frozenset(
    "ad ads advert advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer header cookie cookies consent notice popup modal newsletter subscribe "
    "social share related comment comments reader-comments disqus reply replies login search "
    "complementary contentinfo".split()
)
MAIN = frozenset(("article", "main"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
SPACE = re.compile(r"[\s\x1c-\x1f]+")


def marked(attributes: str) -> bool:
    """Whether a word of class, id or role is one of ``MARKED``."""
    return any(
        not MARKED.isdisjoint(value.strip("\"'").lower().split())
        for name, value in ATTRIBUTE.findall(attributes)
        if name.lower() in ("class", "id", "role")
    )


def page_lines(html: str) -> list[tuple[str, int]]:
    """The lines of a page, one for each block of text with its white space collapsed, in page order.

    With each line comes its place: 2 inside an article or main element, 1 outside, 0 inside an
    element that cannot be part of the article by its name, class, id or role. A main element is
    never cut by a class, id or role that it has or inherits; nor is an article (then 1) if it is
    the only such one and nothing else on the page is in place 2. End tags that are missing are made up for by the end of an enclosing element; a page may break off anywhere.
    """
    lines: list[tuple[str, int]] = []
    open_tags: list[tuple[str, int]] = []  # name, place inside
    piece: list[str] = []
    place = 1  # -1 inside a marked element, -2 in an article there
    doubtful = 0  # articles that are marked or stand in a marked element

    def close() -> None:
        if piece:
            text = SPACE.sub(" ", unescape("".join(piece))).strip()
            piece.clear()
            if text:
                lines.append((text, place))

    at = 0
    while at < len(html):
        tag = TOKEN.search(html, at)
        if tag is None:
            piece.append(html[at:])
            break
        if tag.start() > at:
            piece.append(html[at : tag.start()])
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        if tag[1] or tag[4]:
            if any(n == name for n, _ in open_tags):
                if name not in INLINE:
                    close()
                while open_tags.pop()[0] != name:
                    pass
                place = open_tags[-1][1] if open_tags else 1
            elif name not in INLINE:
                close()
            continue
        if name not in INLINE:
            close()
        attributes = tag[3] or tag[6] or ""
        if name in VOID or attributes.endswith("/") and name in INLINE:
            continue
        inside = place
        if name in BOILERPLATE or place == 0:
            inside = 0
        elif name == "main":
            inside = 2
        elif place == -1 or attributes and name not in ("html", "body") and marked(attributes):
            inside = -2 if name == "article" else -1
            doubtful += name == "article"
        elif place == -2:
            inside = -2
        elif name in MAIN:
            inside = 2
        if name in RAW:
            end = re.compile(rf"</{name}\s*>|\Z", re.I).search(html, at)
            at = end.end()
            continue
        if inside != place:
            close()
        if name == "p" and open_tags and open_tags[-1][0] == "p":
            open_tags.pop()
        open_tags.append((name, inside))
        place = inside
    close()
    kept = 1 if doubtful == 1 and all(p != 2 for _, p in lines) else 0
    return [(text, kept if p == -2 else max(p, 0)) for text, p in lines]


def common_lines(mine: list, other: list) -> list[bool]:
    """Which lines of ``mine`` belong to a longest common subsequence with ``other``.

    Equal ends are taken at once and lines that the other side lacks are left out, neither of which
    shortens the subsequence. The rest is split in halves (Hirschberg), with the lengths of all
    prefixes from one bit row each, so memory is linear in the lines.
    """
    shared = [False] * len(mine)
    start = 0
    while start < min(len(mine), len(other)) and mine[start] == other[start]:
        shared[start] = True
        start += 1
    a, b = len(mine), len(other)
    while min(a, b) > start and mine[a - 1] == other[b - 1]:
        a, b = a - 1, b - 1
        shared[a] = True
    known, own = set(other[start:b]), set(mine[start:a])
    left = [i for i in range(start, a) if mine[i] in known]
    right = [x for x in other[start:b] if x in own]
    jobs = [(left, right)]
    while jobs:
        rows, columns = jobs.pop()
        if not rows or not columns:
            continue
        if len(rows) == 1:
            shared[rows[0]] = mine[rows[0]] in columns
            continue
        half = len(rows) // 2
        first = _prefix_lengths([mine[i] for i in rows[:half]], columns)
        last = _prefix_lengths([mine[i] for i in reversed(rows[half:])], columns[::-1])[::-1]
        cut = int(np.argmax(first + last))
        jobs += [(rows[:half], columns[:cut]), (rows[half:], columns[cut:])]
    return shared


def _prefix_lengths(rows: list, columns: list) -> np.ndarray:
    """Length of the longest common subsequence of ``rows`` with each prefix of ``columns``. A zero
    bit marks a column at which the length grows (bit-parallel form of Crochemore and others)."""
    m = len(columns)
    where: dict = {}
    for j, x in enumerate(columns):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << m) - 1
    row = full
    for x in rows:
        match = where.get(x, 0)
        row = ((row + (row & match)) | (row & ~match)) & full
    raw = np.frombuffer(row.to_bytes((m + 7) // 8, "little"), dtype=np.uint8)
    grows = 1 - np.unpackbits(raw, bitorder="little", count=m).astype(np.int64)
    return np.concatenate([[0], np.cumsum(grows)])


def line_key(text: str) -> int:
    """64 bits of a line."""
    raw = text.encode("utf-8", "replace")
    return crc32(raw) << 31 ^ crc32(raw[::-1], 7)


def _parsed(batch: pa.RecordBatch) -> list[list[tuple[str, int]]]:
    return [[] if html is None else page_lines(html) for html in batch.column("html").to_pylist()]


def _kept_place(lines: list[tuple[str, int]]) -> int:
    """The place of the lines that may be text: article and main elements, if there are any."""
    return 2 if any(place == 2 for _, place in lines) else 1


def _outlines(batch: pa.RecordBatch) -> list:
    """Keys of all lines of each page, and the characters of those that may be text, 0 for others."""
    parsed = [(lines, _kept_place(lines)) for lines in _parsed(batch)]
    return [
        [[line_key(text) for text, _ in lines] for lines, _ in parsed],
        [[len(text) if place == kept else 0 for text, place in lines] for lines, kept in parsed],
    ]


def _candidates(batch: pa.RecordBatch) -> list:
    """The lines that may be text, each with its position on the page, below 0 in an article."""
    texts, at = [], []
    for lines in _parsed(batch):
        kept = _kept_place(lines)
        keep = [(i, t) for i, (t, place) in enumerate(lines, 1) if place == kept]
        texts.append([t for _, t in keep])
        at.append([-i if kept == 2 else i for i, _ in keep])
    return [texts, at]


# Two pages are nearly the same if they share this part of the characters that may be text on the
# page that has fewer of them.
NEAR = 0.9


def near(keys: np.ndarray, sizes: np.ndarray, other_keys: np.ndarray, other_sizes: np.ndarray) -> bool:
    """Whether two pages are nearly the same, by the lines that may be text on either."""
    least = min(int(sizes.sum()), int(other_sizes.sum()))
    if not least:
        return False
    mine, other = ({}, {})
    for lines, k, n in ((mine, keys, sizes), (other, other_keys, other_sizes)):
        for key, size in zip(k.tolist(), n.tolist()):
            if size:
                lines[key] = lines.get(key, 0) + size
    return sum(min(size, other.get(key, 0)) for key, size in mine.items()) >= NEAR * least


def _near(batch: pa.RecordBatch) -> list:
    return [[near(*x) for x in zip(*(lists_of(batch, c) for c in ("keys", "sizes", "next_keys", "next_sizes")))]]


def _alignments(batch: pa.RecordBatch) -> list:
    """The lines shared with the nearest page, and those shared with the pages on both sides."""
    columns = [lists_of(batch, c) for c in ("keys", "sizes", "last_keys", "last_sizes", "next_keys", "next_sizes")]
    edits = [batch.column(c).to_pylist() for c in ("last_edits", "next_edits")]
    once, twice = [], []
    for keys, sizes, *sides, last, following in zip(*columns, *edits):
        found = [
            (distance, common_lines(keys.tolist(), k.tolist()))
            for distance, k, n in ((last, *sides[:2]), (following, *sides[2:]))
            if distance is not None and not near(keys, sizes, k, n)
        ]
        once.append(min(found, key=lambda x: x[0])[1] if found else [])
        twice.append([a and b for a, b in zip(found[0][1], found[1][1])] if len(found) == 2 else [])
    return [once, twice]


def keyed(pages: DataFrame) -> DataFrame:
    """``pages`` with a key of each row's content. Rows alike in every column share it."""
    return pages.select("page_id", "url", "html").withColumn(
        "row_key", F.xxhash64("page_id", F.col("url"), F.lit("|"), F.col("html"))
    )


def outlines(pages: DataFrame) -> DataFrame:
    """``(row_key, host, path, outline, keys, sizes)``, one row for each different page; pages of a
    host with the same lines share ``outline``."""
    new = "keys array<bigint>, sizes array<int>"
    lines = map_batches(keyed(pages), ["row_key", "url"], new, _outlines)
    address = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)"
    placed = lines.select(
        "row_key",
        F.lower(F.coalesce(F.regexp_extract("url", address, 1), F.lit(""))).alias("host"),
        F.coalesce(F.regexp_extract("url", address, 2), F.lit("")).alias("path"),
        "keys",
        "sizes",
    ).dropDuplicates(["row_key"])
    return placed.withColumn("outline", F.xxhash64("host", "keys", "sizes"))


def runs(slim: DataFrame) -> DataFrame:
    """``(place, host, path, outline, keys, sizes, run)``: one page of each outline of each host, in
    the order of host and path; those that follow each other and are nearly the same are one run."""
    heads = slim.where(F.col("host") != "").groupBy("outline").agg(
        F.min("host").alias("host"), F.min(F.struct("path", "row_key")).alias("head")
    )
    heads = heads.select("outline", "host", F.col("head.path").alias("path"), F.col("head.row_key").alias("row_key"))
    # Lines join after the numbering, which would move them several times.
    order = numbered(heads, ["host", "path", "row_key"], "place")
    order = shared_table(order.join(slim.select("row_key", "keys", "sizes"), "row_key").drop("row_key"))
    following = order.select(
        (F.col("place") - 1).alias("place"),
        F.col("host").alias("next_host"),
        *[F.col(c).alias(f"next_{c}") for c in ("keys", "sizes")],
    )
    both = order.join(following, "place").where(F.col("host") == F.col("next_host"))
    alike = map_batches(both, ["place"], "near boolean", _near).where("near")
    # A page that is not nearly the same as the page before it starts a run.
    starts = order.select("place").join(alike.select((F.col("place") + 1).alias("place"), "near"), "place", "left")
    inside = Window.partitionBy("_block").orderBy("place")
    counted = starts.select("place", F.floor(F.col("place") / BLOCK).alias("_block"), "near")
    counted = counted.withColumn("_run", F.sum(F.col("near").isNull().cast("bigint")).over(inside))
    counted = shared_table(counted.drop("near"))
    # One row for each BLOCK pages.
    blocks = counted.groupBy("_block").agg(F.max("_run").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("_block", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = counted.join(blocks, "_block").select("place", (F.col("_run") + F.col("_before")).alias("run"))
    return order.join(placed, "place")


# Places that are counted in one go.
BLOCK = 4096


def neighbours(slim: DataFrame) -> DataFrame:
    """``(outline, keys, sizes)`` with ``edits``, ``keys`` and ``sizes`` of the last page before and the
    next page after the outline's run, on its host: the edits between the paths, or null and no lines if
    there is no such page. Copies thus have no copy for a neighbour. Pages without a host have none."""
    members = shared_table(runs(slim))
    beside = ("host", "path", "keys", "sizes")
    ends = members.groupBy("run").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("from"), F.max("place").alias("to")
    )

    def side(step: int, prefix: str) -> DataFrame:
        return members.select(
            (F.col("place") + step).alias("from" if step > 0 else "to"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in beside],
        )

    around = ends.join(side(1, "last"), "from", "left").join(side(-1, "next"), "to", "left").drop("from", "to")
    both = join_counted(members, shared_table(around), "run", members.count())

    def edits(prefix: str):
        distance = F.levenshtein("path", f"{prefix}_path", EDITS)
        there = F.col("host") == F.col(f"{prefix}_host")
        return F.when(there, F.when(distance < 0, EDITS + 1).otherwise(distance)).alias(f"{prefix}_edits")

    def lines(column: str, kind: str):
        return F.coalesce(F.col(column), F.array().cast(f"array<{kind}>")).alias(column)

    return both.select(
        "outline",
        "keys",
        "sizes",
        *[edits(p) for p in ("last", "next")],
        *[lines(f"{p}_{c}", k) for p in ("last", "next") for c, k in (("keys", "bigint"), ("sizes", "int"))],
    )


# Paths that take more edits than this count as equally far.
EDITS = 64


def shared_lines(pages: DataFrame) -> DataFrame:
    """``(row_key, shared, twice)``: for each page with a neighbour, which of its lines are in a longest
    common subsequence with the lines of the nearer neighbour (the one before, if both are as near),
    and which are in one with both neighbours. Lines travel as 64-bit keys."""
    slim = shared_table(outlines(pages))
    new = "shared array<boolean>, twice array<boolean>"
    found = map_batches(neighbours(slim), ["outline"], new, _alignments)
    copies = slim.groupBy("outline").agg(F.count(F.lit(1)).alias("n"))
    rows = slim.select("row_key", "outline")
    both = join_counted(rows, shared_table(found.join(copies, "outline")), "outline", slim.count())
    return both.select("row_key", "shared", "twice")


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars, n_lines, n_shared)`` for every row of ``pages`` (page_id, url,
    html): the lines that the page does not share with its nearest page, joined by single spaces.

    Copies and near copies are no neighbours, so they do not take each other's text. Articles quote
    each other, so lines inside an article or main element go only if the neighbours before and after
    both have them; if there is such an element, lines outside it go. Lines in elements
    that cannot belong to an article (menus, headers, footers, sidebars, notices, adverts, forms,
    reader comments, scripts, styles) go even if no other page has them. A null, empty or textless
    page gives an empty text; repeated rows give a row each; ``n_shared`` counts shared lines.
    """
    texts = map_batches(
        keyed(pages), ["row_key", "page_id", "url"], "lines array<string>, at array<int>", _candidates
    )
    joined = texts.join(shared_lines(pages), "row_key", "left")
    stays = F.filter(
        F.arrays_zip("lines", "at"),
        lambda x: ~F.coalesce(
            F.when(x["at"] > 0, F.get(F.col("shared"), x["at"] - 1)).otherwise(F.get(F.col("twice"), -x["at"] - 1)),
            F.lit(False),
        ),
    )
    text = F.array_join(F.transform(stays, lambda x: x["lines"]), " ")
    shared = F.size(F.filter(F.coalesce(F.col("shared"), F.array().cast("array<boolean>")), lambda x: x))
    return joined.select(
        "page_id",
        "url",
        text.alias("text"),
        F.char_length(text).cast("bigint").alias("n_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        shared.cast("bigint").alias("n_shared"),
    )
