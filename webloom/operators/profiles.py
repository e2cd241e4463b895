"""Content-based recommending: item features, user profiles and cosine ranking.

Profiles are long tables ``(item, feature, weight)``; there is never one column for each term.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions import text as text_fn
from webloom.functions.vectors import cosine_of
from webloom.operators.skew import HOT_ROWS, hot_keys, join_skewed
from webloom.session import cut_lineage

# Feature families in order of precedence: a later family drops labels an earlier one has.
CATEGORY, PRICE, TERM = "category", "price", "term"
PRICE_FEATURE = "price"
# Feature rows a block of users or items should not exceed by much.
BLOCK_ROWS = 2_000_000


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by ``order``, as a distributed top-k."""
    return df.orderBy(*order).limit(n)


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first column of each label; touches only the schema."""
    unique = [f"_{i}" for i in range(len(df.columns))]
    first = {}
    for position, label in enumerate(df.columns):
        first.setdefault(label, unique[position])
    return df.toDF(*unique).select(*[F.col(u).alias(label) for label, u in first.items()])


def clean_ratings(ratings: DataFrame) -> DataFrame:
    """Projected ratings without rows that miss a value."""
    return ratings.select("user", "item", "rating").na.drop().where(~F.isnan("rating"))


def mean_rating(ratings: DataFrame) -> DataFrame:
    """Mean rating of each user and item, partially aggregated before the shuffle."""
    return ratings.groupBy("user", "item").agg(F.avg("rating").alias("rating"))


def rated_items(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Items somebody rated. Ratings collapse to distinct items first."""
    return items.join(ratings.select("item").distinct(), "item", "left_semi")


def category_features(items: DataFrame) -> DataFrame:
    """One presence row ``(item, feature, weight)`` for each distinct category of an item."""
    labels = F.explode_outer(F.array_distinct("category")).alias("feature")
    present = items.select("item", labels).where(F.col("feature").isNotNull())
    return present.withColumn("weight", F.lit(1.0))


def category_vocabulary(items: DataFrame) -> DataFrame:
    return category_features(items).select("feature").distinct()


def price_features(items: DataFrame) -> DataFrame:
    """Price scaled to [0, 1] over all items; items without a price get no row."""
    priced = items.select("item", text_fn.parse_price(F.col("price")).alias("value")).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    low = priced.select(F.min("value")).scalar()
    high = priced.select(F.max("value")).scalar()
    scaled = F.when(high > low, (F.col("value") - low) / (high - low)).otherwise(F.lit(0.0))
    return priced.select("item", F.lit(PRICE_FEATURE).alias("feature"), scaled.alias("weight"))


def description_text(items: DataFrame) -> DataFrame:
    """``(item, text)``: description pieces joined by a space, nothing for a missing description."""
    joined = F.coalesce(F.array_join("description", " "), F.lit(""))
    return items.select("item", joined.alias("text"))


def tfidf(
    texts: DataFrame,
    min_rows: int = HOT_ROWS,
    taken: DataFrame | None = None,
) -> DataFrame:
    """TF-IDF rows ``(item, feature, weight)`` of ``(item, text)``.

    Lower-case words of two or more characters; raw counts times ln((1+n)/(1+df)) + 1, scaled to
    unit length for each item. A term in a third of all items is salted on its join. ``taken``
    ``(feature)`` names labels to leave out after scaling; they are marked on the small frequency
    table, so the rows themselves are joined only once.
    """
    counts = (
        texts.select(
            "item", F.explode_outer(text_fn.vocabulary_words(F.col("text"))).alias("feature")
        )
        .where(F.col("feature").isNotNull())
        .groupBy("item", "feature")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    frequency = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("df"))
    n = texts.select(F.count(F.lit(1))).scalar()
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1
    terms = frequency.select("feature", idf.alias("idf"), F.lit(False).alias("dropped"))
    if taken is not None:
        marks = taken.select("feature", F.lit(True).alias("mark"))
        terms = terms.join(marks, "feature", "left").select(
            "feature", "idf", F.coalesce("mark", F.lit(False)).alias("dropped")
        )
    weighted = join_skewed(
        counts,
        terms,
        ["feature"],
        hot=hot_keys(frequency, ["feature"], min_rows, weight="df"),
    ).withColumn("raw", F.col("tf") * F.col("idf"))
    # The terms of one item come from one text value, which bounds the window.
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("item")))
    scaled = weighted.select(
        "item", "feature", (F.col("raw") / length).alias("weight"), "dropped"
    )
    return scaled.where(~F.col("dropped")).drop("dropped")


def item_profiles(items: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Category, price and term features of all items as ``(item, family, feature, weight)``.

    A label belongs to the first family that has it: terms spelt like a category or like the price
    column are dropped for all items, after scaling.
    """
    categories = category_features(items)
    labels = categories.select("feature").distinct()
    named_price = labels.where(F.col("feature") == PRICE_FEATURE).select(F.count(F.lit(1)))
    price = price_features(items).where(named_price.scalar() == 0)
    terms = tfidf(description_text(items), min_rows, taken=labels)
    terms = terms.where(F.col("feature") != PRICE_FEATURE)
    blocks = [(categories, CATEGORY), (price, PRICE), (terms, TERM)]
    tagged = [b.select("item", F.lit(f).alias("family"), "feature", "weight") for b, f in blocks]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def user_profiles(
    ratings: DataFrame, profiles: DataFrame, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Rating-weighted mean of the item vectors of each user: ``(user, feature, weight)``.

    Ratings of one item are averaged first. A user whose ratings sum to 0 has the zero vector,
    which in long form is no rows. An item with very many ratings is salted.
    """
    # Written once: it is counted, split and joined.
    mean = cut_lineage(mean_rating(ratings.where(F.col("user").isNotNull())))
    hot = hot_keys(mean, ["item"], min_rows)
    # The features of an item come from one row, which bounds the lists.
    vectors = (
        profiles.groupBy("item")
        .agg(F.collect_list(F.struct("feature", "weight")).alias("vector"))
        .select("item", F.col("vector.feature").alias("features"), F.col("vector.weight").alias("weights"))
    )
    busy = F.broadcast(hot_keys(mean, ["user"], min_rows))
    # An item's vector travels to the user as two lists in one row and is spread there. Of users with
    # very many ratings the sums travel instead.
    few = join_skewed(mean.join(busy, "user", "left_anti"), vectors, ["item"], hot=hot)
    few = few.select("user", "rating", "features", "weights").repartition("user")
    many = join_skewed(mean.join(busy, "user", "left_semi"), vectors, ["item"], hot=hot)
    return _weighted_means(few).unionByName(_weighted_means(many))


def _weighted_means(rated: DataFrame) -> DataFrame:
    """``(user, feature, weight)`` from ``(user, rating, features, weights)``, a row for each rated item."""
    # Place 0 of the lists stands for the item itself and sums up to the total of the ratings.
    lists = F.arrays_zip(
        F.concat(F.array(F.lit(None).cast("string")), "features").alias("feature"),
        F.concat(F.array(F.lit(1.0)), "weights").alias("weight"),
    )
    summed = (
        rated.select("user", "rating", F.posexplode_outer(lists).alias("place", "entry"))
        .groupBy("user", (F.col("place") == 0).alias("whole"), F.col("entry.feature").alias("feature"))
        .agg(F.sum(F.col("entry.weight") * F.col("rating")).alias("weighted"))
    )
    # One row for each user and feature by now: no user has more rows than there are features.
    total = F.max(F.when(F.col("whole"), F.col("weighted"))).over(Window.partitionBy("user"))
    return (
        summed.withColumn("total", total)
        .where((F.col("total") > 0) & ~F.col("whole"))
        .select("user", "feature", (F.col("weighted") / F.col("total")).alias("weight"))
    )


def top_items(
    users: DataFrame,
    profiles: DataFrame,
    k: int = 2,
    user_block: int = 16384,
    item_block: int = 65536,
) -> DataFrame:
    """The ``k`` items nearest to each user profile by cosine: ``(user, rank, item, score)``.

    Exact, without scoring all pairs. Every user meets a bounded number of items first; the ``k``-th
    best of them is a threshold that holds for all others. Users and items fall into blocks of bounded
    size, items of the same heaviest features next to each other, each block written once as one row;
    every two meet in one task, which reads them where they are. There, items of the same heaviest
    features form groups, those of the same features in all form subgroups, and these are halved into
    leaves of few items; the greatest weight of each feature bounds the scores of all items below.
    Groups, subgroups and leaves whose bound lies below the threshold are left out, and the items of
    the rest are scored. The best of all blocks are merged by a window with a group limit. Rated items
    stay in, ties go to the smaller item.
    """
    if k <= 0:
        raise ValueError("k must be greater than 0")
    users = cut_lineage(users.select("user", "feature", "weight"))
    items = cut_lineage(_item_rows(profiles))
    user_keys, user_rows = users.agg(F.count_distinct("user"), F.count(F.lit(1))).first()
    item_keys, item_rows = items.agg(F.count(F.lit(1)), F.sum(F.size("features"))).first()
    user_blocks = _blocks_for(user_keys, user_rows, user_block)
    item_blocks = _blocks_for(item_keys, item_rows or 0, item_block)
    # Few long vectors or many short ones: a bounded number of rows either way.
    first = max(k, min(SEEDS, SEED_ROWS * item_keys // max(item_rows or 0, 1)))
    seeds = items.orderBy(F.xxhash64("item"), "item").limit(first).select("item", "features", "weights").toArrow()
    left = _packed_users(users, user_blocks, _block_of_lists(seeds), k)
    right = _packed_items(items, item_blocks, k)
    user_type = users.schema["user"].dataType.simpleString()
    item_type = profiles.schema["item"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("users"), batch.column("items")):
                *mine, least = _unpacked(a)
                mine, grouped = Block(*mine), GroupedItems(*_unpacked(b))
                user, item, found, _ = _best_of(mine, least, grouped, k)
                columns = [mine.ids.take(pa.array(user)), grouped.ids.take(pa.array(item)), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, ["user", "item", "score"])

    # A block is a partition of one row, so nothing is shuffled and a task gets two blocks. A single
    # block, which is bounded, goes to the others.
    if user_blocks > 1 and item_blocks > 1:
        met = left.select("users").crossJoin(right.select("items").hint("shuffle_replicate_nl"))
    elif item_blocks == 1:
        met = left.join(F.broadcast(right), "side").select("users", "items")
    else:
        met = right.join(F.broadcast(left), "side").select("users", "items")
    partial = met.mapInArrow(score, f"user {user_type}, item {item_type}, score double")
    best = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    return (
        partial.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("user", "rank", "item", "score")
    )


def _blocks_for(keys: int, rows: int, keys_in_block: int) -> int:
    """Number of blocks that keeps both the keys and the rows of a block near a fixed size."""
    return max(1, ceil(keys / keys_in_block), ceil(rows / BLOCK_ROWS))


def _item_rows(profiles: DataFrame) -> DataFrame:
    """``(item, leading, features, weights)``, a row for each item; ``leading`` are its heaviest features.
    The features of an item come from one row, which bounds the lists."""
    vectors = profiles.groupBy("item").agg(
        F.sort_array(F.collect_list(F.struct("feature", "weight"))).alias("vector")
    )
    heavy = F.sort_array(F.transform("vector", lambda x: F.struct((-x["weight"]).alias("w"), x["feature"].alias("f"))))
    return vectors.select(
        "item",
        F.sort_array(F.slice(heavy, 1, GROUP_FEATURES)["f"]).alias("leading"),
        F.col("vector.feature").alias("features"),
        F.col("vector.weight").alias("weights"),
    )


def _packed_users(users: DataFrame, blocks: int, seeds: Block, k: int) -> DataFrame:
    """``(side, users)``: the unit vectors of all users in ``blocks`` partitions of one row, with the
    least score that an item has to reach to be of a user's ``k`` best. Written once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            rows = pa.Table.from_batches(held)
            mine = _block(rows["user"], rows["feature"], rows["weight"].to_numpy())
            yield _packed((*mine, _thresholds(mine, seeds, k)), "users")

    dealt = users.repartition(blocks, "user")
    return cut_lineage(dealt.mapInArrow(pack, "side int, users binary"))


def _packed_items(items: DataFrame, blocks: int, k: int) -> DataFrame:
    """``(side, items)``: all items in ``blocks`` partitions of one row, in which those of the same
    heaviest features lie together, grouped. Written once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield _packed(GroupedItems.of(_block_of_lists(pa.Table.from_batches(held)), k), "items")

    dealt = items.repartitionByRange(blocks, "leading", "item").select("item", "features", "weights")
    return cut_lineage(dealt.mapInArrow(pack, "side int, items binary"))


def _packed(parts: tuple, name: str) -> pa.RecordBatch:
    """One row of plain arrays; sparse rows go as their columns, since a worker may lack this package."""
    raw = pickle.dumps([x.plain() if isinstance(x, Rows) else x for x in parts], protocol=5)
    body = len(raw).to_bytes(8, "big") + pa.compress(raw, codec="lz4", asbytes=True)
    columns = [pa.array([0], pa.int32()), pa.array([body], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["side", name])


def _unpacked(body: pa.BinaryScalar) -> list:
    held = body.as_buffer()
    size = int.from_bytes(held[:8].to_pybytes(), "big")
    parts = pickle.loads(pa.decompress(held[8:], decompressed_size=size, codec="lz4"))
    return [Rows(*x, ordered=True) if isinstance(x, tuple) else x for x in parts]


def _unit_vectors(vectors: DataFrame) -> DataFrame:
    """Rows ``(id, feature, weight)`` scaled to unit length; zero vectors keep weight 0."""
    length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy("id")))
    return vectors.select("id", "label", cosine_of(F.col("value"), length).alias("value"))


# Features whose set makes a group of items, the heaviest ones.
GROUP_FEATURES = 3
# Items that share a bound at last.
LEAF_ITEMS = 16
# Items that every user meets for a threshold, and their feature rows. Not a cut: no result depends on them.
SEEDS = 8192
SEED_ROWS = 500_000
# Numbers of a dense matrix in a task, and users that are compared at a time.
DENSE = 1 << 23
USERS_AT_ONCE = 4096
# More than rounding can move a score.
ROUNDING = 1e-9


class Rows:
    """Sparse rows ``row, column, value`` in row order; ``starts`` has one entry more than there are rows."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, ordered: bool = False):
        order = slice(None) if ordered else np.lexsort((column, row))
        self.row, self.column = row[order].astype(np.int32), column[order].astype(np.int32)
        self.value = value[order]
        self.starts = np.searchsorted(self.row, np.arange(rows + 1))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def plain(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        return self.row, self.column, self.value, len(self)

    def picked(self, which: np.ndarray) -> Rows:
        at, owner = _expanded(self.starts, which)
        return Rows(owner, self.column[at], self.value[at], len(which), ordered=True)

    def dense(self, first: int, last: int, width: int) -> np.ndarray:
        made = np.zeros((last - first, width))
        part = slice(self.starts[first], self.starts[last])
        made[self.row[part] - first, self.column[part]] = self.value[part]
        return made


class Block(NamedTuple):
    """Sparse vectors: their ids and the labels of their columns, both ascending."""

    ids: pa.Array
    labels: pa.Array
    rows: Rows


def _block(ids: pa.ChunkedArray, label: pa.ChunkedArray, value: np.ndarray, scaled: bool = True) -> Block:
    """A block of rows ``(id, label, value)``, each vector scaled to unit length; zero vectors keep weight 0."""
    (ids, row), (labels, column) = _coded(ids), _coded(label)
    if scaled:
        length = np.sqrt(np.bincount(row, weights=value * value, minlength=len(ids)))[row]
        value = np.divide(value, length, out=np.zeros(len(value)), where=length > 0)
    # Of a label that a vector has twice the greatest value counts, in bounds and scores alike.
    cell, at = np.unique(row * max(len(labels), 1) + column, return_inverse=True)
    most = np.full(len(cell), -np.inf)
    np.maximum.at(most, at.ravel(), value)
    return Block(ids, labels, Rows(*np.divmod(cell, max(len(labels), 1)), most, len(ids), ordered=True))


def _block_of_lists(items: pa.Table) -> Block:
    """A block of rows ``(item, features, weights)``."""
    items = items.combine_chunks()
    owner = pc.list_parent_indices(items["features"])
    weights = pc.list_flatten(items["weights"]).to_numpy()
    return _block(items["item"].take(owner), pc.list_flatten(items["features"]), weights)


def _coded(values: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in ascending order, null before all, and the place of each value there."""
    whole = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks) if whole.num_chunks else pa.array([], whole.type)
    coded = whole.dictionary_encode(null_encoding="encode")
    order = pc.array_sort_indices(coded.dictionary, null_placement="at_start").to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


class GroupedItems(NamedTuple):
    """The items of a block in groups, subgroups (parts) and leaves, with bounds of their weights (the
    greatest, the least); items are numbered in that order, and ``item`` has the place of each in ``ids``."""

    ids: pa.Array
    labels: pa.Array
    item: np.ndarray
    rows: Rows
    group_starts: np.ndarray
    part_starts: np.ndarray
    leaf_starts: np.ndarray
    most_of_groups: Rows
    least_of_groups: Rows
    most_of_parts: Rows
    least_of_parts: Rows
    most_of_leaves: Rows
    least_of_leaves: Rows

    @classmethod
    def of(cls, block: Block, k: int) -> GroupedItems:
        """Of equal vectors only the first ``k`` stay: they come before the others in every ranking."""
        width = len(block.labels)
        kept = _first_of_equal(block.rows, k)
        rows, n = block.rows.picked(kept), len(kept)
        heavy = np.lexsort((rows.column, -rows.value, rows.row))
        place = np.arange(len(heavy)) - rows.starts[rows.row[heavy]]
        top = place < GROUP_FEATURES
        leading = np.full((n, GROUP_FEATURES), -1)
        leading[rows.row[heavy][top], place[top]] = rows.column[heavy][top]
        group = np.unique(np.sort(leading, axis=1), axis=0, return_inverse=True)[1].ravel()
        # Two sets of features with one mark would only share a bound.
        whole = _marks(rows, rows.column.astype(np.uint64))
        part = np.unique(
            np.stack([group.astype(np.uint64), whole], axis=1), axis=0, return_inverse=True
        )[1].ravel()
        order, leaf = _leaves(rows, part, width)
        rows = rows.picked(order)
        group, part, leaf = group[order], part[order], leaf[order]
        # Leaves are numbered in the order of their parts, parts in the order of their groups.
        leaf_starts = _starts(leaf)
        part_starts = _starts(part[leaf_starts[:-1]])
        group_starts = _starts(group[leaf_starts[part_starts[:-1]]])
        bounds = [_extreme(rows, x, width, most) for x in (group, part, leaf) for most in (True, False)]
        return cls(block.ids, block.labels, kept[order], rows, group_starts, part_starts, leaf_starts, *bounds)

    @property
    def samples(self) -> np.ndarray:
        """The first item of each group, and one of about every leaf."""
        firsts = self.leaf_starts[self.part_starts[self.group_starts[:-1]]]
        return np.union1d(firsts, np.arange(0, len(self.item), LEAF_ITEMS))


def _starts(numbers: np.ndarray) -> np.ndarray:
    """Where each of the ascending ``numbers`` 0, 1, 2, ... starts, and the end."""
    return np.searchsorted(numbers, np.arange((int(numbers[-1]) + 1 if len(numbers) else 0) + 1))


def _marks(rows: Rows, cells: np.ndarray) -> np.ndarray:
    """A number for each row, the sum of its scrambled cells."""
    mark = (cells + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mark ^= mark >> np.uint64(29)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mark * mark, dtype=np.uint64)])
    return total[rows.starts[1:]] - total[rows.starts[:-1]]


def _first_of_equal(rows: Rows, k: int) -> np.ndarray:
    """The rows without those that have ``k`` equal ones before them."""
    bits = (rows.value + 0.0).view(np.uint64)
    mark = _marks(rows, (rows.column.astype(np.uint64) << np.uint64(32)) ^ (bits * np.uint64(0xC2B2AE3D27D4EB4F)))
    order, sizes = np.argsort(mark, kind="stable"), np.diff(rows.starts)
    one, other = order[:-1], order[1:]
    same = (mark[one] == mark[other]) & (sizes[one] == sizes[other])
    # What the marks suggest is looked at number by number.
    (x, owner), (y, _) = _expanded(rows.starts, one[same]), _expanded(rows.starts, other[same])
    differ = (rows.column[x] != rows.column[y]) | (rows.value[x] != rows.value[y])
    same[same] = np.bincount(owner, weights=differ, minlength=int(same.sum())) == 0
    new = np.concatenate([np.ones(min(len(order), 1), dtype=bool), ~same])
    place = np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    return np.sort(order[place < k])


def _leaves(rows: Rows, part: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows in the order of their leaves, and the leaf of each row: parts halved along the widest
    feature until none has more than ``LEAF_ITEMS`` rows."""
    leaf = part
    while True:
        order = np.argsort(leaf, kind="stable")
        sizes = np.bincount(leaf) if len(leaf) else np.zeros(0, dtype=int)
        if not len(sizes) or sizes.max() <= LEAF_ITEMS:
            return order, leaf
        most, least = (_extreme(rows, leaf, width, x) for x in (True, False))
        widest = np.lexsort((most.value - least.value, most.row))[most.starts[1:] - 1]
        axis = most.column[widest]
        at = np.zeros(len(leaf))
        mine = rows.column == axis[leaf[rows.row]]
        at[rows.row[mine]] = rows.value[mine]
        order = np.lexsort((at, leaf))
        place = np.arange(len(order)) - (np.cumsum(sizes) - sizes)[leaf[order]]
        upper = np.empty(len(leaf), dtype=np.int64)
        size = sizes[leaf[order]]
        upper[order] = (size > LEAF_ITEMS) & (place >= size // 2)
        leaf = np.unique(leaf * 2 + upper, return_inverse=True)[1].ravel()


def _extreme(rows: Rows, group: np.ndarray, width: int, most: bool) -> Rows:
    """The greatest or least weight of each feature in a group; an item without it has 0."""
    sizes = np.bincount(group) if len(group) else np.zeros(0, dtype=int)
    cell = group[rows.row].astype(np.int64) * width + rows.column
    order = np.argsort(cell, kind="stable")
    new = np.flatnonzero(np.diff(cell[order], prepend=-1))
    if not len(new):
        return Rows(cell, cell, rows.value, len(sizes))
    value = (np.maximum if most else np.minimum).reduceat(rows.value[order], new)
    cell, held = cell[order][new], np.diff(new, append=len(order))
    missing = held < sizes[cell // width]
    value = np.where(missing, np.maximum(value, 0) if most else np.minimum(value, 0), value)
    return Rows(cell // width, cell % width, value, len(sizes), ordered=True)


def _expanded(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places ``starts[w]`` to ``starts[w + 1]`` of every ``w``, and for each place whose it is."""
    sizes = starts[which + 1] - starts[which]
    owner = np.repeat(np.arange(len(which)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[which], sizes), owner


def _dots(dense: np.ndarray, user: np.ndarray, rows: Rows, row: np.ndarray) -> np.ndarray:
    """Products of users with sparse rows, pair by pair."""
    made = np.zeros(len(user))
    for first in range(0, len(user), DENSE // 8):
        u, r = user[first : first + DENSE // 8], row[first : first + DENSE // 8]
        at, owner = _expanded(rows.starts, r)
        terms = dense[u[owner], rows.column[at]] * rows.value[at]
        made[first : first + len(u)] = np.bincount(owner, weights=terms, minlength=len(u))
    return made


def _all_dots(dense: np.ndarray, rows: Rows) -> np.ndarray:
    """Products of all users with all of some sparse rows: ``(users, rows)``."""
    # A gathered product takes some hundred times as long as one of a matrix product.
    if len(rows) * dense.shape[1] > 400 * len(rows.row):
        user, row = np.divmod(np.arange(len(dense) * len(rows)), max(len(rows), 1))
        return _dots(dense, user, rows, row).reshape(len(dense), len(rows))
    step = max(1, DENSE // dense.shape[1])
    parts = [
        dense @ rows.dense(first, min(first + step, len(rows)), dense.shape[1]).T
        for first in range(0, len(rows), step)
    ]
    return np.concatenate(parts, axis=1)


def _all_bounds(dense: np.ndarray, extremes: list[Rows]) -> np.ndarray:
    bound = _all_dots(np.maximum(dense, 0), extremes[0])
    if (dense < 0).any():
        bound += _all_dots(np.minimum(dense, 0), extremes[1])
    return bound


def _open_parts(dense: np.ndarray, stay: np.ndarray, least: np.ndarray, grouped: GroupedItems):
    """Pairs of a user and a subgroup whose bound reaches the user's threshold, among the groups
    ``(users, groups)`` that do; a group has few features, so a small product each."""
    users, parts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    most = grouped.most_of_groups
    for group in np.flatnonzero(stay.any(axis=0)).tolist():
        user = np.flatnonzero(stay[:, group])
        first, last = grouped.group_starts[group : group + 2].tolist()
        columns = most.column[most.starts[group] : most.starts[group + 1]]
        mine = dense[np.ix_(user, columns)]
        high, low = (_narrow(x, first, last, columns) for x in (grouped.most_of_parts, grouped.least_of_parts))
        bound = np.maximum(mine, 0) @ high.T
        if (mine < 0).any():
            bound += np.minimum(mine, 0) @ low.T
        row, part = np.nonzero(bound >= least[user, None])
        users.append(user[row])
        parts.append(part + first)
    return np.concatenate(users), np.concatenate(parts)


def _narrow(rows: Rows, first: int, last: int, columns: np.ndarray) -> np.ndarray:
    """Some sparse rows as a dense matrix of those columns that they have."""
    made = np.zeros((last - first, len(columns)))
    part = slice(rows.starts[first], rows.starts[last])
    made[rows.row[part] - first, np.searchsorted(columns, rows.column[part])] = rows.value[part]
    return made


def _open_leaves(dense: np.ndarray, user: np.ndarray, part: np.ndarray, least: np.ndarray, grouped: GroupedItems):
    """Pairs of a user and a leaf whose bound reaches the user's threshold, among open subgroups."""
    leaf, owner = _expanded(grouped.part_starts, part)
    user = user[owner]
    bound = _dots(np.maximum(dense, 0), user, grouped.most_of_leaves, leaf)
    if (dense < 0).any():
        bound += _dots(np.minimum(dense, 0), user, grouped.least_of_leaves, leaf)
    near = bound >= least[user]
    return user[near], leaf[near]


def _known(users: Block, labels: pa.Array) -> Rows:
    """The vectors of users in columns ``labels``. Features that no item has do not count for a product."""
    feature = pc.index_in(users.labels, value_set=labels).fill_null(-1).to_numpy(zero_copy_only=False)
    feature = feature[users.rows.column]
    shared = feature >= 0
    # Both lists of labels are ascending, so the order stays.
    return Rows(users.rows.row[shared], feature[shared], users.rows.value[shared], len(users.rows), ordered=True)


def _thresholds(users: Block, seeds: Block, k: int) -> np.ndarray:
    """The ``k``-th best score of each user among ``seeds``: no less is of the ``k`` best of all items."""
    vectors, width, n = _known(users, seeds.labels), len(seeds.labels), len(seeds.rows)
    least = np.full(len(vectors), -np.inf)
    if k <= n:
        step = max(1, min(USERS_AT_ONCE, DENSE // max(width, 1), DENSE // n))
        for first in range(0, len(vectors), step):
            last = min(first + step, len(vectors))
            scores = _all_dots(vectors.dense(first, last, width), seeds.rows)
            least[first:last] = np.partition(scores, n - k, axis=1)[:, n - k] - ROUNDING
    return least


def _best_of(
    users: Block, least: np.ndarray, grouped: GroupedItems, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of users and of items, and scores, for the top ``k`` items of one item block for each user
    of one user block, as far as they reach the user's ``least``; and how many pairs were scored."""
    vectors, width, groups = _known(users, grouped.labels), len(grouped.labels), len(grouped.group_starts) - 1
    step = max(1, min(USERS_AT_ONCE, DENSE // max(width, 1), DENSE // max(groups, 1)))
    found, scored = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))], 0
    ranges = [(x, min(x + step, len(vectors))) for x in range(0, len(vectors), step)][::-1]
    while ranges:
        first, last = ranges.pop()
        dense, wanted = vectors.dense(first, last, width), least[first:last]
        stay = _all_bounds(dense, [grouped.most_of_groups, grouped.least_of_groups]) >= wanted[:, None]
        user, part = _open_parts(dense, stay, wanted, grouped)
        held = grouped.leaf_starts[grouped.part_starts[part + 1]] - grouped.leaf_starts[grouped.part_starts[part]]
        if held.sum() > DENSE and last - first > 1:
            # Too many pairs for one turn.
            middle = (first + last) // 2
            ranges += [(middle, last), (first, middle)]
            continue
        user, leaf = _open_leaves(dense, user, part, wanted, grouped)
        row, owner = _expanded(grouped.leaf_starts, leaf)
        user = user[owner]
        # Rounding keeps equal scores equal whatever the order of addition.
        score = _dots(dense, user, grouped.rows, row).round(12)
        scored += len(score)
        near = score >= wanted[user]
        user, item, score = user[near], grouped.item[row[near]], score[near]
        order = np.lexsort((item, -score, user))
        user, item, score = user[order], item[order], score[order]
        rank = np.arange(len(user)) - np.searchsorted(user, user)
        best = rank < k
        found.append((user[best] + first, item[best], score[best]))
    return *(np.concatenate(x) for x in zip(*found)), scored


def best_in_block(a: pd.DataFrame, b: pd.DataFrame, k: int) -> tuple[pd.DataFrame, int]:
    """Top ``k`` items of one item block for each user of one user block, and how many pairs of a user
    and an item were scored for it. Both frames hold unit vectors ``(id, label, value)``. A sample of the
    items makes the threshold."""
    users, items = (
        _block(pa.array(x["id"]), pa.array(x["label"], pa.string()), x["value"].to_numpy(), scaled=False) for x in (a, b)
    )
    grouped = GroupedItems.of(items, k)
    seeds = Block(grouped.ids, grouped.labels, grouped.rows.picked(grouped.samples))
    user, item, score, scored = _best_of(users, _thresholds(users, seeds, k), grouped, k)
    found = {"user": users.ids.take(pa.array(user)).to_pandas(), "item": items.ids.take(pa.array(item)).to_pandas()}
    return pd.DataFrame({**found, "score": score}), scored + len(users.rows) * len(seeds.rows)
