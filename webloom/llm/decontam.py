"""Benchmark passages in documents, found by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import keep_rows, map_batches, plain

WINDOW_WORDS = 10
# Words of benchmark text that are searched for in one pass over the documents. Larger benchmarks
# take several passes, so what is broadcast stays within this bound.
PASS_WORDS = 2_000_000
# Words that one lane of the search walks through.
LANE = 128
# Words are runs of ASCII digits, ASCII letters and anything beyond ASCII.
_IS_WORD = bytes(c if chr(c).isdigit() or chr(c).islower() or c > 127 else 32 for c in range(256))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[bytes]:
    """Words in order, A-Z lower-cased."""
    return text.encode("utf-8", "replace").lower().translate(_IS_WORD).split()


@dataclass
class Table:
    """Patterns of one length with their Wu-Manber tables; words are numbers, blocks are two words
    (one for patterns of a single word)."""

    length: int
    patterns: np.ndarray  # (n, length), in the order of their last blocks
    items: list[tuple[int, ...]]  # numbers of the items with this pattern
    blocks: np.ndarray  # all blocks in patterns, sorted
    shifts: np.ndarray  # how far a window that ends in the block may move on
    suffixes: np.ndarray  # last blocks of patterns, sorted: the buckets
    starts: np.ndarray  # first pattern of each bucket, with one more for the end

    @property
    def block(self) -> int:
        return min(2, self.length)


def block_ids(words: np.ndarray, size: int) -> np.ndarray:
    """The block that ends at each word, from the second word on for blocks of two."""
    return words.astype(np.int64) if size == 1 else (words[:-1].astype(np.int64) << 32) | words[1:]


def build_tables(items: list[list[bytes]], window: int = WINDOW_WORDS) -> tuple[dict[bytes, int], list[Table]]:
    """Word numbers (from 1; 0 is any other word) and one table for each pattern length."""
    number: dict[bytes, int] = {}
    found: dict[int, dict[tuple[int, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
    for i, words in enumerate(items):
        ids = [number.setdefault(w, len(number) + 1) for w in words]
        length = min(window, len(ids))
        for at in range(len(ids) - length + 1 if ids else 0):
            found[length][tuple(ids[at : at + length])].add(i)
    return number, [_table(length, found[length]) for length in sorted(found)]


def _table(length: int, patterns: dict[tuple[int, ...], set[int]]) -> Table:
    size = min(2, length)
    matrix = np.array(list(patterns), dtype=np.int64).reshape(len(patterns), length)
    owners = [tuple(sorted(o)) for o in patterns.values()]
    columns = [block_ids(row, size) for row in matrix]
    last = np.array([c[-1] for c in columns])
    order = np.argsort(last, kind="stable")
    every = np.concatenate(columns)
    distance = np.tile(np.arange(length - size, -1, -1), len(columns))
    by_block = np.lexsort((distance, every))
    blocks, first = np.unique(every[by_block], return_index=True)
    suffixes, starts = np.unique(last[order], return_index=True)
    return Table(
        length,
        matrix[order],
        [owners[i] for i in order],
        blocks,
        distance[by_block][first],
        suffixes,
        np.append(starts, len(last)),
    )


def occurrences(words: np.ndarray, table: Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ends of windows and the patterns found there, as pairs of arrays.

    The text is walked in many lanes at once. A lane looks at the block that ends its window: the
    shift table moves it on by as far as no pattern can end, at shift zero the bucket of the block
    names the patterns to compare in full.
    """
    m, size = table.length, table.block
    if len(words) < m:
        return
    blocks = block_ids(words, size)  # the block ending at word i is number i - size + 1
    at = np.arange(m - 1, len(words), LANE)
    until = np.minimum(at + LANE, len(words))
    longest = m - size + 1
    while len(at):
        block = blocks[at - size + 1]
        place = np.minimum(np.searchsorted(table.blocks, block), len(table.blocks) - 1)
        shift = np.where(table.blocks[place] == block, table.shifts[place], longest)
        ends = at[shift == 0]
        if len(ends):
            bucket = np.searchsorted(table.suffixes, blocks[ends - size + 1])
            first, count = table.starts[bucket], np.diff(table.starts)[bucket]
            # Compare the n-th pattern of every bucket, for buckets that have so many.
            for nth in range(int(count.max())):
                more = count > nth
                pattern, end = first[more] + nth, ends[more]
                window = words[end[:, None] + np.arange(1 - m, 1)]
                equal = (window == table.patterns[pattern]).all(axis=1)
                if equal.any():
                    yield end[equal], pattern[equal]
        at = at + np.maximum(shift, 1)
        alive = at < until
        at, until = at[alive], until[alive]


def find(words: list[bytes], number: dict[bytes, int], tables: list[Table]) -> tuple[np.ndarray, set[int]]:
    """Which words stand inside an occurrence of a window, and the items these windows come from."""
    ids = np.fromiter(map(number.get, words, repeat(0)), dtype=np.int64, count=len(words))
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    items: set[int] = set()
    if ids.any():
        for table in tables:
            for ends, patterns in occurrences(ids, table):
                np.add.at(edges, ends - table.length + 1, 1)
                np.add.at(edges, ends + 1, -1)
                for p in set(patterns.tolist()):
                    items.update(table.items[p])
    return np.cumsum(edges[:-1]) > 0, items


def runs(hit: np.ndarray) -> list[list[int]]:
    """First word and end of each run of hit words."""
    change = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [[int(a), int(b)] for a, b in zip(change[::2], change[1::2])]


def benchmark_passes(benchmark: DataFrame, bound: int = PASS_WORDS) -> list[list[tuple[str, list[bytes]]]]:
    """The items with words, as ``(id, words)``, in parts of at most about ``bound`` words; an item
    goes to a part by a hash of its id. Rows that repeat an id are items of one id."""
    counted = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").withColumn(
        "n", F.size(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    )
    total = counted.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-2 * total // bound)) if total > bound else 1
    cut = F.pmod(F.xxhash64("id"), F.lit(parts))
    passes = []
    for part in range(parts):
        rows = counted.where((cut == part) & F.col("id").isNotNull()).select("id", "text").collect()
        items = [(r["id"], words_of(r["text"] or "")) for r in rows]
        passes.append([x for x in items if x[1]])
    return passes


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, bound: int = PASS_WORDS) -> DataFrame:
    """``(doc_id, n_words, spans, items)`` for every row of ``docs``: the runs of words inside
    occurrences of benchmark windows, as first word and end, and the ids of the items found, sorted as
    strings.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. Null and empty
    texts have no words; items without words or id are passed over; an empty benchmark finds nothing.
    """
    result = docs.select("doc_id", "text")
    for items in benchmark_passes(benchmark, bound):
        result = _one_pass(result, items, window, "spans" in result.columns)
    return result.select("doc_id", "n_words", "spans", "items")


def _tables(spark: SparkSession, items: list[tuple[str, list[bytes]]], window: int):
    """Item ids, word numbers and pattern tables of one pass; at most PASS_WORDS words."""
    number, tables = build_tables([w for _, w in items], window)
    return spark.sparkContext.broadcast(([i for i, _ in items], number, [plain(t) for t in tables]))


def _known(value: tuple) -> tuple[list[str], dict[bytes, int], list[Table]]:
    return value[0], value[1], [Table(*t) for t in value[2]]


def _one_pass(source: DataFrame, items: list[tuple[str, list[bytes]]], window: int, more: bool) -> DataFrame:
    """``source`` with what this pass finds, added to what earlier passes found."""
    shared = _tables(source.sparkSession, items, window)

    def search(batch: pa.RecordBatch) -> list:
        names, number, tables = _known(shared.value)
        counts, spans, found = [], [], []
        for text in batch.column("text").to_pylist():
            words = [] if text is None else words_of(text)
            hit, ids = find(words, number, tables)
            counts.append(len(words))
            spans.append(runs(hit))
            found.append({names[x] for x in ids})
        if more:
            spans = [_union(a + b) for a, b in zip(spans, batch.column("spans").to_pylist())]
            found = [a | set(b) for a, b in zip(found, batch.column("items").to_pylist())]
        return [counts, spans, [sorted(f) for f in found]]

    return map_batches(
        source, ["doc_id", "text"], "n_words bigint, spans array<array<int>>, items array<string>", search
    )


def _union(spans: list[list[int]]) -> list[list[int]]:
    """Spans that overlap or touch, put together."""

    def add(done: list[list[int]], span: list[int]) -> list[list[int]]:
        if done and span[0] <= done[-1][1]:
            done[-1][1] = max(done[-1][1], span[1])
        else:
            done.append(list(span))
        return done

    return reduce(add, sorted(spans), [])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of every row of ``docs``."""
    found = scan(docs, benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without an occurrence of a benchmark window, in their columns. Rows
    without an id are judged by their own text as all others are."""
    for items in benchmark_passes(benchmark):
        docs = _without(docs, _tables(docs.sparkSession, items, WINDOW_WORDS))
    return docs


def _without(docs: DataFrame, shared) -> DataFrame:
    def clean(texts: list[str | None]) -> list[bool]:
        _, number, tables = _known(shared.value)
        return [text is None or not find(words_of(text), number, tables)[1] for text in texts]

    return keep_rows(docs, "text", clean)


def sha256_of(ids: list[str]) -> str:
    """The digest of a list of item ids, as the query reports it."""
    return sha256(",".join(sorted(ids)).encode()).hexdigest()
