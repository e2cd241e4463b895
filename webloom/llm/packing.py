"""Sequences of bounded length packed from documents by a grouping genetic algorithm on islands."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import shared_table, slices
from webloom.llm.vocab import BYTE_BPE, id_bytes, public_path

CAPACITY = 1024
END_ID = 2
# Items of a problem, about; islands that work on one problem, individuals of an island, children
# that an island makes in an epoch, epochs (elites move on between them).
PROBLEM = 32768
ISLANDS = 3
POPULATION = 6
CHILDREN = 16
EPOCHS = 3
# A bin that lacks at most this part of the capacity is well filled.
SLACK = 0.002


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the ids of each text and the end id, in pieces of at
    most ``capacity``; ``ids`` are little-endian unsigned 32-bit integers.

    Texts of more than ``capacity`` ids are cut so that all pieces but the first are full. A null or
    empty text is its end id alone. Rows that repeat an id are documents of their own, other columns
    are left out, no rows give no rows. ``vocabulary`` is a file that every executor can read.
    """
    path = vocabulary or public_path(BYTE_BPE)
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = id_bytes(path)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, place, start, ids = [], [], [], []
                for i, made in enumerate(encoder.of(part.column("text").to_pylist())):
                    made += end
                    first = (len(made) // 4 - 1) % capacity + 1
                    bounds = [0, *range(first, len(made) // 4 + 1, capacity)]
                    for n, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                        rows.append(i)
                        place.append(n)
                        start.append(a)
                        ids.append(made[4 * a : 4 * b])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, type=pa.int32())),
                        pa.array(place, type=pa.int32()),
                        pa.array(start, type=pa.int64()),
                        pa.array([len(x) // 4 for x in ids], type=pa.int64()),
                        pa.array(ids, type=pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


class Bins:
    """Bins of a packing, with the open ones by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        # Bit r is set if a bin with room r is open, so the tightest fit is the lowest bit from the size on.
        self.rooms = 0

    def open(self, bin_: int, room: int) -> None:
        if room:
            self.by_room[room].append(bin_)
            self.rooms |= 1 << room

    def best_fit(self, sizes: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        """Bins for items taken in order, each where it leaves least room; new bins are numbered from
        ``fresh`` on."""
        placed = np.empty(len(sizes), dtype=np.int32)
        by_room = self.by_room
        for i, size in enumerate(sizes.tolist()):
            fitting = self.rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                stack = by_room[room]
                bin_ = stack.pop()
                if not stack:
                    self.rooms ^= 1 << room
            else:
                bin_, room = fresh, self.capacity
                fresh += 1
            placed[i] = bin_
            self.open(bin_, room - size)
        return placed, fresh


def fills(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=sizes).astype(np.int64)


def numbered_anew(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Mean of the squared fills, which prefers few bins and, among as many, full ones beside empty ones."""
    return float(np.square(fills(sizes, bins) / capacity).sum() / (bins.max() + 1))


def first_packing(sizes: np.ndarray, capacity: int, rng: np.random.Generator | None) -> np.ndarray:
    """Best fit of the items by decreasing size, or by about decreasing size."""
    key = sizes if rng is None else sizes * rng.uniform(0.85, 1.15, len(sizes))
    order = np.argsort(-key, kind="stable")
    bins = np.empty(len(sizes), dtype=np.int32)
    bins[order], _ = Bins(capacity).best_fit(sizes[order], 0)
    return bins


def crossed(
    sizes: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int, slack: int, rng: np.random.Generator
) -> np.ndarray:
    """A child of two packings: whole well-filled bins of ``giver`` are injected into ``taker``, whose
    bins with one of their items, or with the most room, are dissolved; what stood in these and is
    not injected is best-fitted again."""
    full = fills(sizes, giver) >= capacity - slack
    chosen = full & (rng.random(len(full)) < rng.uniform(0.3, 0.9))
    injected = chosen[giver]
    filled = fills(sizes, taker)
    hit = np.zeros(len(filled), dtype=bool)
    hit[taker[injected]] = True
    # Mutation: of the bins that are not full, some are dissolved as well.
    hit |= (filled < capacity - slack) & (rng.random(len(filled)) < rng.uniform(0.2, 1.0))
    displaced = hit[taker] & ~injected
    child = taker.copy()
    child[injected] = giver[injected] + len(filled)
    bins = Bins(capacity)
    for bin_ in np.flatnonzero(~hit & (filled < capacity)).tolist():
        bins.open(bin_, int(capacity - filled[bin_]))
    loose = np.flatnonzero(displaced)
    key = sizes[loose] * rng.uniform(0.97, 1.03, len(loose))
    loose = loose[np.argsort(-key, kind="stable")]
    child[loose], _ = bins.best_fit(sizes[loose], len(filled) + len(full))
    return numbered_anew(child)


def evolved(
    sizes: np.ndarray, population: list[np.ndarray], seed: int, capacity: int, children: int, wanted: int
) -> list[np.ndarray]:
    """An epoch of one island: the population (made if empty), bred and cut back to the fittest."""
    rng = np.random.default_rng(seed)
    slack = int(capacity * SLACK)
    if not population:
        population = [first_packing(sizes, capacity, None if i == 0 else rng) for i in range(wanted)]
    rated = [(fitness(sizes, p, capacity), i, p) for i, p in enumerate(population)]
    rated.sort(key=lambda r: (-r[0], r[1]))
    least = -(-int(sizes.sum()) // capacity)
    for born in range(children):
        best = rated[0][2]
        if best.max() + 1 == least and (fills(sizes, best) < capacity).sum() <= 1:
            break  # no packing is better
        # Both parents from the ranks, the better ones more often.
        a, b = (int(len(rated) * rng.random() ** 2) for _ in range(2))
        if a == b:
            b = (a + 1) % len(rated)
        child = crossed(sizes, rated[a][2], rated[b][2], capacity, slack, rng)
        rated.append((fitness(sizes, child, capacity), len(population) + born, child))
        rated.sort(key=lambda r: (-r[0], r[1]))
        rated = rated[:wanted]
    return [p for _, _, p in rated]


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _bred(islands: DataFrame, epoch: int, capacity: int, children: int, population: int) -> DataFrame:
    """``(problem, island, sizes, packings, score)`` after one more epoch; ``packings`` holds the individuals
    behind each other, the fittest first, ``score`` its fitness. A problem's items are bounded."""

    def breed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for problem, island, sizes, known in zip(
                batch.column("problem").to_pylist(),
                batch.column("island").to_pylist(),
                _lists(batch.column("sizes")),
                _lists(batch.column("packings")),
            ):
                there = list(known.reshape(-1, len(sizes)))
                seed = [epoch, island, problem]
                bred = evolved(sizes, there, seed, capacity, children, population)
                found.append(np.concatenate(bred))
                scores.append(fitness(sizes, bred[0], capacity))
            columns = [batch.column(c) for c in ("problem", "island", "sizes")]
            made = pa.array(found, type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*columns, made, pa.array(scores, type=pa.float64())],
                names=["problem", "island", "sizes", "packings", "score"],
            )

    schema = "problem bigint, island int, sizes array<int>, packings array<int>, score double"
    return islands.select("problem", "island", "sizes", "packings").mapInArrow(breed, schema)


def _migrated(islands: DataFrame, number: int) -> DataFrame:
    """Every island gets the elite of the one before it."""
    elite = islands.select(
        "problem",
        F.pmod(F.col("island") + 1, F.lit(number)).alias("island"),
        F.slice("packings", F.lit(1), F.size("sizes")).alias("elite"),
    )
    return islands.join(elite, ["problem", "island"]).select(
        "problem", "island", "sizes", F.concat("packings", "elite").alias("packings")
    )


def _settled(problems: DataFrame, capacity: int, last: bool) -> DataFrame:
    """``(key, size, problem, bin, offset, kept)`` from problems with their best packing. Well-filled
    bins are kept, and the fuller half in any case, so that what goes on at least halves; on the
    last level all are."""
    slack = int(capacity * SLACK)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for problem, keys, sizes, bins in zip(
                batch.column("problem").to_pylist(),
                _lists(batch.column("keys")),
                _lists(batch.column("sizes")),
                _lists(batch.column("best")),
            ):
                filled = fills(sizes, bins)
                kept = filled >= capacity - slack
                kept[np.argsort(-filled, kind="stable")[: len(filled) // 2 + 1]] = True
                order = np.argsort(bins, kind="stable")
                inside = np.cumsum(sizes[order]) - sizes[order]
                first = np.cumsum(filled) - filled
                offsets = np.empty(len(sizes), dtype=np.int64)
                offsets[order] = inside - first[bins[order]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys),
                        pa.array(sizes),
                        pa.array(np.full(len(keys), problem, dtype=np.int64)),
                        pa.array(bins),
                        pa.array(offsets),
                        pa.array(np.ones(len(keys), dtype=bool) if last else kept[bins]),
                    ],
                    names=["key", "size", "problem", "bin", "offset", "kept"],
                )

    schema = "key bigint, size int, problem bigint, bin int, offset bigint, kept boolean"
    return problems.select("problem", "keys", "sizes", "best").mapInArrow(settle, schema)


def packed(
    items: DataFrame,
    capacity: int = CAPACITY,
    problem: int = PROBLEM,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    children: int = CHILDREN,
    population: int = POPULATION,
) -> DataFrame:
    """``(key, sequence_id, offset)`` for ``items`` ``(key, size)``, keys unique, sizes 1 to ``capacity``.

    Items that fill a sequence stand alone. The others are dealt by a hash of their key into problems
    of about ``problem`` items, so each has a like mix of sizes however often one size occurs. Several
    islands, rows of a table, work on each problem: they start from best-fit packings, breed by
    injecting whole well-filled bins, and between epochs, written to the shared folder, each passes
    its best packing on. Of the best packing of a problem the well-filled bins are kept; the items of
    the others go on to a next level of fewer problems, until one problem is left. So the room lost
    is that of the last problem, and of the slack that well-filled bins may have. Each level has at
    most about half the items of the one before it. Every draw is seeded by level, problem, island
    and epoch: a lost task makes the same bins again. No items give no rows.
    """
    single = items.where(F.col("size") == capacity).select(
        "key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    rest = items.where(F.col("size") < capacity).select("key", F.col("size").cast("int").alias("size"))
    done, level = [single], 0
    while True:
        number = max(1, -(-rest.count() // problem))
        dealt = rest.withColumn("problem", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(number)))
        # About ``problem`` items of two numbers; sorted, as the order they come in is not repeatable.
        listed = dealt.groupBy("problem").agg(F.sort_array(F.collect_list(F.struct("size", "key"))).alias("items"))
        problems = shared_table(listed.select("problem", F.col("items.key").alias("keys"), F.col("items.size").alias("sizes")))
        nobody = F.array().cast("array<int>")
        state = problems.select(
            "problem", "sizes", nobody.alias("packings"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")
        )
        for epoch in range(epochs):
            state = state if epoch == 0 else _migrated(state, islands)
            spread = state.repartition(_partitions(rest, number * islands), "problem", "island")
            state = shared_table(_bred(spread, 1000 * level + epoch, capacity, children, population))
        elite = F.slice("packings", F.lit(1), F.size("sizes"))
        best = state.groupBy("problem").agg(
            F.max_by(elite, F.struct(F.col("score"), -F.col("island"))).alias("best")
        )
        settled = shared_table(_settled(problems.join(best, "problem"), capacity, number == 1))
        # Levels, problems and bins are far below these powers of two.
        name = F.lit(level << 56) + F.shiftleft(F.col("problem"), 20) + F.col("bin")
        done.append(settled.where("kept").select("key", name.alias("sequence_id"), "offset"))
        if number == 1:
            return reduce(DataFrame.unionByName, done)
        rest, level = settled.where(~F.col("kept")).select("key", "size"), level + 1


def _partitions(df: DataFrame, most: int) -> int:
    return max(1, min(most, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def placed_pieces(cut: DataFrame, capacity: int = CAPACITY, **parameters) -> DataFrame:
    """The rows of ``cut`` ``(length, ...)`` with ``sequence_id`` and ``offset``.

    The rows are written with a number of their own first, so pieces that agree in all columns stay
    apart. Columns of the names that are added give way.
    """
    rows = shared_table(cut.drop("sequence_id", "offset").withColumn("_key", F.monotonically_increasing_id()))
    where = packed(rows.select(F.col("_key").alias("key"), F.col("length").alias("size")), capacity, **parameters)
    return rows.join(where.withColumnRenamed("key", "_key"), "_key").drop("_key")


def sequences(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, **parameters) -> DataFrame:
    """``(sequence_id, n_ids, ids)``: the packed sequences themselves, at most ``capacity`` ids each."""
    placed = placed_pieces(pieces(docs, vocabulary, capacity), capacity, **parameters)
    # A sequence has at most ``capacity`` pieces.
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), inside.alias("p")).select(
        "sequence_id", "n_ids", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )


def packing_table(docs: DataFrame, vocabulary: str | None = None, **parameters) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row for each piece. Ids
    become checksums where they are made; only these are packed and joined."""
    cut = pieces(docs, vocabulary, parameters.get("capacity", CAPACITY))
    slim = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return placed_pieces(slim, **parameters)
