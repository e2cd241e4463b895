"""Similarity join of documents by word n-grams: an LSH forest of MinHash prefixes, exactly verified."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import groups, join_counted, lists_of, map_batches, shared_table

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Trees of the forest, the longest prefix of a tree, and the wanted recall of pairs at the threshold.
TREES = 12
DEPTH = 6
RECALL = 0.9995
# Sets of a bucket that meet in one task and the bytes they may have together. Nodes of the forest with
# more keep longer prefixes; what is still larger at the end is cut into blocks of about this size.
BLOCK = 2048
BLOCK_BYTES = 16 << 20
# Rows of a comparison matrix that are held at a time.
TILE = 512


def prefix_length(threshold: float, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """Length of the prefixes that must match. Starting from the whole label, prefixes are shortened
    until two documents whose similarity is just the threshold agree on one in some tree with
    probability ``recall``; more similar documents do so more often."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    if 1 - (1 - threshold**depth) ** trees < recall:
        raise ValueError("so many trees cannot reach that recall; take more")
    return depth


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all their bits count."""
    x = values.copy()
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct 64-bit hashes of the n-grams of word hashes; fewer than ``n`` words make one n-gram."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    w = words.astype(np.int64).view(np.uint64)
    n = min(n, len(w))
    rolled = np.zeros(len(w) - n + 1, dtype=np.uint64)
    for i in range(n):
        rolled = mixed(rolled + w[i : len(w) - n + 1 + i] + np.uint64(n))
    return np.unique(rolled)


def trees_needed(threshold: float, recall: float, depth: int) -> int:
    """How many trees find a pair at the threshold with probability ``recall`` by whole labels."""
    return ceil(log(1 - recall) / log(1 - threshold**depth))


def labels(
    members: np.ndarray, trees: int, shortest: int, longest: int, depth: int, step: int = 2048
) -> np.ndarray:
    """Keys of the prefixes of each tree's label, tree by tree, from ``shortest`` to ``longest`` values:
    a prefix's key folds the tree's number and its MinHash values, so it does not depend on how much
    of the label is made."""
    number = np.add.outer(np.arange(trees) * depth, np.arange(1, longest + 1)).ravel().astype(np.uint64)
    a = mixed(number * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    b = mixed(number + np.uint64(0xA0761D6478BD642F))
    least = np.full(trees * longest, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(members), step):
        part = members[start : start + step, None] * a + b
        part ^= part >> np.uint64(32)
        np.minimum(least, part.min(axis=0), out=least)
    keys = np.arange(trees, dtype=np.uint64)
    prefixes = []
    for column in least.reshape(trees, longest).T:
        keys = mixed(keys + column)
        prefixes.append(keys)
    return np.stack(prefixes[shortest - 1 :], axis=1).ravel().view(np.int64)


def word_hashes(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, words)``: 64-bit hashes of the text and of its lower-cased words, in order."""
    words = F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[ \t\n\r\f\x0B]+")
    kept = F.filter(words, lambda w: w != "")
    hashes = F.transform(kept, lambda w: F.xxhash64(w)).alias("words")
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), hashes)


def digest(members: np.ndarray) -> bytes | None:
    """128 bits that stand for a set of n-grams; none for the empty set."""
    return blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None


def sketches(docs: DataFrame, n: int, trees: int, shortest: int, longest: int, depth: int) -> DataFrame:
    """``(doc_id, text_hash, print, size, keys)``: digest and size of the set of n-grams and the keys of
    ``labels``; no digest for a document without words."""

    def sketch(batch: pa.RecordBatch) -> list:
        sets = [shingle_set(w, n) for w in lists_of(batch, "words")]
        keys = [labels(s, trees, shortest, longest, depth) if len(s) else None for s in sets]
        return [[digest(s) for s in sets], [len(s) for s in sets], keys]

    return map_batches(
        word_hashes(docs), ["doc_id", "text_hash"], "print binary, size bigint, keys array<bigint>", sketch
    )


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """``(print, members)``."""

    def collect(batch: pa.RecordBatch) -> list:
        sets = [shingle_set(w, n) for w in lists_of(batch, "words")]
        return [[digest(s) for s in sets], [s.view(np.int64) for s in sets]]

    return map_batches(word_hashes(docs), [], "print binary, members array<bigint>", collect)


def texts_of(docs: DataFrame, asked: DataFrame, printed: DataFrame) -> DataFrame:
    """One text for each set in ``asked`` (print), found by document and hash of the text."""
    one = printed.join(asked, "print", "left_semi").groupBy("print").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("row")
    )
    wanted = one.select("row.doc_id", "row.text_hash").distinct()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.join(wanted, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])


CELL = ["key", "block_a", "block_b"]


def node_rows(sets: DataFrame) -> DataFrame:
    """``(print, size, tree, key)``: the nodes of the forest each set stands in, written once."""
    return shared_table(sets.select("print", "size", F.posexplode("keys").alias("tree", "key")))


def longer_prefixes(
    sets: DataFrame, rows: DataFrame, deep_keys, trees: int, span: int, all_trees: int, block: int
) -> DataFrame | None:
    """``sets`` with longer prefixes in crowded nodes, None if no node is crowded.

    A node with more than ``block`` sets hands them on to its children, level by level, until they
    are small enough or labels end. Both sets of a pair in a crowded node take part, so it still
    meets wherever it agrees so far. What the longer prefixes lose in recall, further trees make up for:
    the sets of crowded nodes enter ``all_trees`` of them, the further ones by their whole labels.
    ``deep_keys(asked)`` gives ``(print, deep)``, ``span`` keys of each tree."""
    crowded = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    crowded = shared_table(crowded)
    if crowded.isEmpty():
        return None
    left = shared_table(join_counted(rows, crowded, "key", rows.count()).select("print", "tree"))
    deep = shared_table(deep_keys(left.select("print").distinct()))
    placed = []
    for level in range(1, span):
        at = F.element_at("deep", F.col("tree") * span + F.lit(level + 1))
        here = shared_table(left.join(deep, "print").select("print", "tree", at.alias("key")))
        if level == span - 1:
            placed.append(here)
            break
        full = here.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
        full = shared_table(full)
        left = shared_table(join_counted(here, full, "key", here.count()).select("print", "tree"))
        placed.append(here.join(left, ["print", "tree"], "left_anti"))
    table = placed[0]
    for more in placed[1:]:
        table = table.unionByName(more)
    # At most one entry for each tree.
    changed = table.groupBy("print").agg(
        F.map_from_entries(F.collect_list(F.struct("tree", "key"))).alias("changed")
    )
    further = F.transform(
        F.sequence(F.lit(trees + 1), F.lit(all_trees)), lambda t: F.element_at("deep", t * span)
    )
    new = changed.join(deep, "print").select("print", "changed", further.alias("further"))
    own = F.transform("keys", lambda k, i: F.coalesce(F.try_element_at("changed", i), k))
    if all_trees > trees:
        own = F.concat(own, F.coalesce("further", F.array().cast("array<bigint>")))
    kept = F.when(F.col("changed").isNull(), F.col("keys")).otherwise(own)
    return shared_table(sets.join(new, "print", "left").select("print", "rep", "size", kept.alias("keys")))


def bucket_cells(sets: DataFrame, rows: DataFrame, block: int) -> DataFrame:
    """``(key, block_a, block_b, side, tree, rep, print, keys)``: the members of each bucket with at
    least two. A bucket of more than ``block`` members or ``BLOCK_BYTES`` is cut by a hash into blocks,
    and each two blocks meet in a cell of their own, so no task holds more than two blocks."""
    crowded = shared_table(
        rows.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), (F.sum("size") * 8).alias("bytes"))
        .where(F.col("n") > 1)
    )
    met = join_counted(rows, crowded, "key", rows.count())
    blocks = F.ceil(
        F.greatest(F.col("n") / F.lit(float(block)), F.col("bytes") / F.lit(float(BLOCK_BYTES)))
    ).cast("int")
    own = F.pmod(F.xxhash64("print", "key"), blocks).cast("int")
    cells = met.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    placed = cells.select(
        "key",
        F.least("own", "other").alias("block_a"),
        F.greatest("own", "other").alias("block_b"),
        "print",
        (F.col("own") > F.col("other")).alias("side"),
        "tree",
    )
    return placed.join(sets.select("rep", "print", "keys"), "print")


class _Cell:
    """The members of a cell as the two sides that are compared: within a block all with all, between
    two blocks those of one with those of the other."""

    def __init__(self, cell: pd.DataFrame):
        self.size, self.tree = len(cell), int(cell["tree"].iloc[0])
        self.keys = np.stack([np.asarray(k[: self.tree + 1], dtype=np.int64) for k in cell["keys"]])
        self.whole = cell["block_a"].iloc[0] == cell["block_b"].iloc[0]
        side = cell["side"].to_numpy(dtype=bool)
        self.rows = np.arange(self.size) if self.whole else np.flatnonzero(~side)
        self.columns = np.arange(self.size) if self.whole else np.flatnonzero(side)

    def tiles(self) -> Iterator[tuple[slice, np.ndarray]]:
        """Runs of rows, and which pairs of each meet here first: in no earlier tree do they share a key."""
        for start in range(0, len(self.rows), TILE):
            part = slice(start, min(start + TILE, len(self.rows)))
            r, c = self.rows[part], self.columns
            new = r[:, None] != c[None, :]
            for t in range(self.tree):
                new &= self.keys[r, t][:, None] != self.keys[c, t][None, :]
            yield part, new


def _newcomers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The members of each cell that meet somebody there for the first time."""
    found: list[pd.DataFrame] = []
    rows = 0
    for cell in groups(batches, CELL):
        sides = _Cell(cell)
        stay = np.zeros(len(cell), dtype=bool)
        for part, new in sides.tiles():
            stay[sides.rows[part]] |= new.any(axis=1)
            stay[sides.columns] |= new.any(axis=0)
        if stay.any():
            found.append(cell[stay])
            rows += int(stay.sum())
        if rows > 5000:
            yield pd.concat(found)
            found, rows = [], 0
    if found:
        yield pd.concat(found)


# Values held by no more sets than this are counted pair by pair, others by matrix products.
RARE = 16


def overlaps(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, step: int = 1024) -> np.ndarray:
    """Sizes of the intersections of the sets ``rows`` with the sets ``columns``: products of incidence
    matrices over the values that many sets hold, ``step`` values at a time, and single additions for
    the values that few hold."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, number, times = np.unique(values, return_inverse=True, return_counts=True)
    by_value = np.argsort(number, kind="stable")
    owner, held = owner[by_value], times[number[by_value]]
    result = np.zeros((len(rows), len(columns)), dtype=np.float32)
    at_row, at_column = np.full(n, -1), np.full(n, -1)
    at_row[rows], at_column[columns] = np.arange(len(rows)), np.arange(len(columns))
    rare = RARE if n > 64 else 1
    for count in np.unique(times[(times > 1) & (times <= rare)]):
        together = owner[held == count].reshape(-1, count)
        for i in range(count):
            for j in range(count):
                r, c = at_row[together[:, i]], at_column[together[:, j]]
                there = (r >= 0) & (c >= 0)
                np.add.at(result, (r[there], c[there]), np.float32(1))
    owner, held = owner[held > rare], held[held > rare]
    total = int((times > rare).sum())
    number = np.repeat(np.arange(total), times[times > rare])
    edges = np.searchsorted(number, np.arange(0, total + step, step))
    for i, start in enumerate(range(0, total, step)):
        part = slice(edges[i], edges[i + 1])
        incidence = np.zeros((n, min(step, total - start)), dtype=np.float32)
        incidence[owner[part], number[part] - start] = 1
        result += incidence[rows] @ incidence[columns].T
    return result


def _verified(threshold: float):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links of each member of a cell that are new there, and the first set it hangs together with
        through them."""
        names = ["rep", "print", "links", "root_rep", "root_print"]
        out: list[tuple] = []
        for cell in groups(batches, CELL):
            if len(cell) < 2:
                continue
            reps, prints = cell["rep"].tolist(), cell["print"].tolist()
            sides = _Cell(cell)
            sets = [np.asarray(m) for m in cell["members"]]
            sizes = np.array([len(s) for s in sets], dtype=np.float64)
            both = overlaps(sets, sides.rows, sides.columns)
            linked = np.zeros(both.shape, dtype=bool)
            links = np.zeros(len(cell), dtype=np.int64)
            for part, new in sides.tiles():
                union = sizes[sides.rows[part], None] + sizes[None, sides.columns] - both[part]
                linked[part] = new & (both[part] >= threshold * union - 1e-9)
            links[sides.rows] += linked.sum(axis=1)
            if not sides.whole:
                links[sides.columns] += linked.sum(axis=0)
            if not links.any():
                continue
            order = sorted(range(len(cell)), key=lambda i: (reps[i], prints[i]))
            root = np.empty(len(cell), dtype=np.int32)
            root[order] = np.arange(len(cell), dtype=np.int32)
            far = np.int32(len(cell))
            while True:
                before = root.copy()
                for part in range(0, len(sides.rows), TILE):
                    r = sides.rows[part : part + TILE]
                    seen = np.where(linked[part : part + TILE], root[sides.columns][None, :], far)
                    root[r] = np.minimum(root[r], seen.min(axis=1))
                    back = np.where(linked[part : part + TILE], root[r][:, None], far)
                    root[sides.columns] = np.minimum(root[sides.columns], back.min(axis=0))
                if (root == before).all():
                    break
            first = [order[k] for k in root]
            out += [
                (reps[i], prints[i], int(links[i]), reps[first[i]], prints[first[i]])
                for i in np.flatnonzero(links)
            ]
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return verify


def in_cells(rows: DataFrame) -> DataFrame:
    """Rows of one cell together and in order. The task count is that of any shuffle."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *CELL).sortWithinPartitions(*CELL)


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node that each end of ``edges`` (node, root) hangs together with.
    Labels spread over the edges and along themselves until none changes; every round is written to
    the shared folder. Nodes with many edges are joined where their edges are."""
    pairs = edges.where(F.col("node") != F.col("root")).distinct()
    both = shared_table(
        pairs.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(
            pairs.select(F.col("root").alias("a"), F.col("node").alias("b"))
        )
    )
    total = both.count()
    state = shared_table(
        both.groupBy("a")
        .agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        .select(F.col("a").alias("node"), F.least("a", "m").alias("label"), "n")
    )
    while True:
        seen = state.select(F.col("node").alias("b"), F.col("label").alias("theirs"), "n")
        near = join_counted(both, seen, "b", total).groupBy("a").agg(F.min("theirs").alias("near"))
        spread = state.join(near.withColumnRenamed("a", "node"), "node", "left").select(
            "node", F.least("label", F.coalesce("near", "label")).alias("lower"), F.col("label").alias("old"), "n"
        )
        jump = state.select(F.col("node").alias("lower"), F.col("label").alias("further"))
        moved = shared_table(
            spread.join(jump, "lower", "left").select(
                "node", F.least("lower", F.coalesce("further", "lower")).alias("label"), "old", "n"
            )
        )
        state = moved.select("node", "label", "n")
        if moved.where(F.col("label") != F.col("old")).isEmpty():
            return state.select("node", "label")


def labelled_rows(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    n: int = SHINGLE_WORDS,
    recall: float = RECALL,
    trees: int = TREES,
    depth: int = DEPTH,
    block: int = BLOCK,
) -> DataFrame:
    """The columns of ``similarity_classes``, ``text_hash`` (64 bits of the row's text) and ``first``,
    whether the row is the first of its class."""
    shortest = prefix_length(threshold, recall, trees, depth)
    table = shared_table(sketches(docs, n, trees, shortest, shortest, depth))
    printed = table.where(F.col("print").isNotNull())
    heads = shared_table(
        printed.groupBy("print").agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("n"),
            F.first("size").alias("size"),
            F.first("keys").alias("keys"),
        )
    )
    sets = heads.where(F.col("rep").isNotNull()).select("print", "rep", "size", "keys")
    rows = node_rows(sets)
    identified = printed.where(F.col("doc_id").isNotNull()).select("print", "doc_id", "text_hash")
    all_trees = max(trees, trees_needed(threshold, recall, depth))

    def deep_keys(asked: DataFrame) -> DataFrame:
        made = sketches(texts_of(docs, asked, identified), n, all_trees, shortest, depth, depth)
        return made.select("print", F.col("keys").alias("deep")).dropDuplicates(["print"])

    longer = longer_prefixes(sets, rows, deep_keys, trees, depth - shortest + 1, all_trees, block)
    if longer is not None:
        sets, rows = longer, node_rows(longer)
    cells = in_cells(bucket_cells(sets, rows, block))
    columns = ["key", "block_a", "block_b", "side", "tree", "rep", "print", "keys"]
    schema = (
        "key bigint, block_a int, block_b int, side boolean, tree int, rep bigint, print binary, keys array<bigint>"
    )
    meetings = shared_table(cells.select(*columns).mapInPandas(_newcomers, schema))
    asked = meetings.select("print").distinct()
    members = shingle_sets(texts_of(docs, asked, identified), n).dropDuplicates(["print"])
    found = shared_table(
        in_cells(meetings.join(members, "print")).mapInPandas(
            _verified(threshold), "rep bigint, print binary, links bigint, root_rep bigint, root_print binary"
        )
    )
    node = F.struct("rep", "print")
    root = F.struct(F.col("root_rep").alias("rep"), F.col("root_print").alias("print"))
    links = found.groupBy("print").agg(F.sum("links").alias("links"))
    labels_of = components(found.select(node.alias("node"), root.alias("root"))).select(
        F.col("node.print").alias("print"), F.col("label")
    )
    own = F.coalesce("label", F.struct("rep", "print"))
    classes = shared_table(
        heads.select("print", "n", "rep")
        .join(labels_of.join(links, "print", "full"), "print", "left")
        .select(
            "print",
            "n",
            F.col("rep").alias("copy_id"),
            own["rep"].alias("class_id"),
            (own["print"] == F.col("print")).alias("head"),
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        )
    )
    named = join_counted(printed.select("doc_id", "text_hash", "print"), classes, "print", printed.count())
    first = F.col("head") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    wordless = table.where(F.col("print").isNull()).select(
        "doc_id",
        F.col("doc_id").alias("class_id"),
        F.col("doc_id").alias("copy_id"),
        F.lit(1).cast("bigint").alias("n_copies"),
        F.lit(0).cast("bigint").alias("n_links"),
        "text_hash",
        F.lit(True).alias("first"),
    )
    return named.select(
        "doc_id", "class_id", "copy_id", F.col("n").alias("n_copies"), "n_links", "text_hash", first.alias("first")
    ).unionByName(wordless)


def similarity_classes(docs: DataFrame, **parameters) -> DataFrame:
    """``(doc_id, class_id, copy_id, n_copies, n_links)``, one row for each row of ``docs``; the
    parameters are those of ``labelled_rows``.

    Documents are sets of lower-cased word n-grams. ``copy_id`` is the first document with the same
    set, ``n_copies`` their number, ``n_links`` the number of different sets whose Jaccard similarity
    with this one is at least ``threshold``, and ``class_id`` the first document that it hangs
    together with through links.

    Equal sets are represented by their digest. Sets whose labels agree on a prefix in some tree of
    the forest meet in a bucket. Prefixes are as short as the wanted recall demands, except below
    crowded nodes: there they stay longer, and further trees keep the recall. A first pass over keys
    alone finds the trees in which two sets meet first, so the sets are sent only there, and each
    pair is verified once, exactly, on its whole sets. Links leave a cell as counts and as one row
    for each set, never as pairs.

    Documents without words (null, empty, blank) are alike to none; shorter than ``n`` words, they
    count as one n-gram. Rows that repeat a document are copies of it; rows with one id and different
    texts are told apart. A null ``doc_id`` is kept, but represents nobody unless all its copies have
    none, and such a set has no links. No rows give no rows.
    """
    return labelled_rows(docs, **parameters).drop("text_hash", "first")


def first_of_each_class(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class does; its columns are those of
    ``docs``. A row that repeats the first document of its class word for word, id included, stays
    with it; rows without an id stay, as they cannot be told apart. Rows are told apart by id and text."""
    rows = labelled_rows(docs, **parameters)
    gone = rows.where(~F.col("first") & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    )
    same = (docs["doc_id"] == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
    return docs.join(gone.distinct(), same, "left_anti").select(*docs.columns)
