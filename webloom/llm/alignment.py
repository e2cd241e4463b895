"""Two tokenizers' ids of one text linked by the bytes that they share, by sparse matrix products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import join_counted, shared_table, slices
from webloom.llm.vocab import (
    BYTE_BPE,
    PIECE_BPE,
    Memory,
    Words,
    byte_vocabulary,
    gathered,
    piece_vocabulary,
    public_path,
)

# Linked id pairs whose counts are broadcast: at 13 bytes each, 50 MB. More are joined.
BROADCAST_PAIRS = 4_000_000
# Units that a worker keeps.
KEPT = 200_000
# An id pair is one number, the A id times this plus the B id.
PAIR = 1 << 15
STATS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


@dataclass
class Sparse:
    """A matrix in compressed rows: row i has the columns ``columns[ends[i]:ends[i + 1]]``, ascending,
    with their ``values``."""

    ends: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of(cls, sizes: np.ndarray, columns: np.ndarray, width: int) -> Sparse:
        """An incidence matrix from the number of ones in each row and their columns."""
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return cls(ends, columns, np.ones(len(columns), dtype=np.int64), width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))

    def transposed(self) -> Sparse:
        order = np.argsort(self.columns, kind="stable")
        sizes = np.bincount(self.columns, minlength=self.width)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return Sparse(ends, self.rows()[order], self.values[order], len(self.ends) - 1)


def product(a: Sparse, b: Sparse) -> Sparse:
    """A·B by rows: row i of the result is the sum of the rows of B that row i of A names, each times
    its value. All rows are worked off at once; equal columns of a row are then added up."""
    sizes = np.diff(b.ends)[a.columns]
    runs = np.repeat(b.ends[:-1][a.columns] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    row, column = np.repeat(a.rows(), sizes), b.columns[runs]
    value = np.repeat(a.values, sizes) * b.values[runs]
    cell = row * b.width + column
    if len(cell) and (np.diff(cell) < 0).any():
        order = np.argsort(cell, kind="stable")
        cell, value = cell[order], value[order]
    new = np.diff(cell, prepend=-1) != 0
    starts = np.flatnonzero(new)
    summed = np.add.reduceat(value, starts) if len(starts) else value
    cell = cell[starts]
    counts = np.bincount(cell // b.width, minlength=len(a.ends) - 1) if b.width else np.zeros(len(a.ends) - 1, int)
    return Sparse(np.concatenate([[0], np.cumsum(counts)]), cell % max(b.width, 1), summed, b.width)


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[Sparse, Sparse, np.ndarray, np.ndarray]:
    """Overlap links, shared-group links, and the group of each A and B token, from the byte offsets
    at which the tokens end; both sequences cover the same bytes.

    Rows of the incidence matrices are tokens, columns bytes. A·Bᵀ holds, for each two tokens that
    overlap, the number of bytes they share. Groups end where both tokenizations do; the product of
    the token-group matrices links all tokens of a group.
    """
    total = int(ends_a[-1]) if len(ends_a) else 0
    sizes_a, sizes_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    every = np.arange(total)
    overlaps = product(Sparse.of(sizes_a, every, total), Sparse.of(sizes_b, every, total).transposed())
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    one_a, one_b = np.ones(len(ends_a), dtype=int), np.ones(len(ends_b), dtype=int)
    shared = product(Sparse.of(one_a, group_a, len(common)), Sparse.of(one_b, group_b, len(common)).transposed())
    return overlaps, shared, group_a, group_b


class Aligner:
    """Alignments of units, many at once, kept by a worker: for each the groups as text, the linked id
    pairs and the counts; nothing for a unit whose tokens do not give its bytes back."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_vocabulary(path_a), piece_vocabulary(path_b)
        if len(self.b.lengths) > PAIR or not self.b.by_units:
            raise ValueError("this piece vocabulary is too large, or has pieces across words")
        self.memory = Memory(self.align, KEPT)

    def align(self, keys: list[str]) -> list[tuple[str, bytes, bytes] | None]:
        made: list[tuple[str, bytes, bytes] | None] = []
        for first in range(0, len(keys), 20_000):
            made += self._align(keys[first : first + 20_000])
        return made

    def _align(self, keys: list[str]) -> list[tuple[str, bytes, bytes] | None]:
        units = [" " + k for k in keys]
        raw = [u.encode() for u in units]
        ids_a, n_a = self.a.encoded(units)
        ids_b, n_b = self.b.encoded(keys)
        good = self._gives_back(raw, ids_a, n_a, self.a) & self._gives_back(raw, ids_b, n_b, self.b)
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b = n_a[good], n_b[good]
        ends_a, ends_b = np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.b.lengths[ids_b])
        # One matrix for all units: tokens of two units share neither bytes nor groups.
        overlaps, shared, group_a, group_b = linked(ends_a, ends_b)
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        links = np.diff(shared.ends[np.concatenate([[0], last_a])])
        groups = np.diff(np.concatenate([[0], group_a[last_a - 1] + 1])) if len(n_a) else n_a
        overlap = np.diff(overlaps.ends[np.concatenate([[0], last_a])])
        stats = np.stack([n_a, n_b, groups, links, overlap], axis=1).astype("<i4")
        pairs = (ids_a.astype(np.int64)[shared.rows()] * PAIR + ids_b[shared.columns]).astype("<i4").tobytes()
        texts = _group_texts(ids_a, ids_b, group_a, group_b, last_a, last_b)
        ends = (4 * np.cumsum(links)).tolist()
        found = zip(
            texts,
            (pairs[x:y] for x, y in zip([0, *ends[:-1]], ends)),
            (row.tobytes() for row in stats),
        )
        return [next(found) if g else None for g in good.tolist()]

    @staticmethod
    def _gives_back(raw: list[bytes], ids: np.ndarray, counts: np.ndarray, vocabulary) -> np.ndarray:
        table = vocabulary.token_bytes
        made = [table[i] for i in ids.tolist()]
        if b"".join(made) == b"".join(raw):
            sizes = np.add.reduceat(np.append(vocabulary.lengths[ids], 0), np.cumsum(counts) - counts)
            if (sizes[counts > 0] == np.array([len(r) for r in raw])[counts > 0]).all() and (counts > 0).all():
                return np.ones(len(raw), dtype=bool)
        ends = np.cumsum(counts).tolist()
        return np.array([b"".join(made[x:y]) == r for x, y, r in zip([0, *ends[:-1]], ends, raw)], dtype=bool)

    def of(self, texts: list[str]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Counts (texts x ``STATS``), groups, and the links' id pairs with their ends, from 0. Texts
        without tokens have none of them."""
        spoken = [i for i, t in enumerate(texts) if t]
        # The space before a text may belong to blanks that follow.
        words = Words.of([" " + texts[i] for i in spoken], leading=True)
        known = self.memory.of(words.keys)
        dumb = np.array([k is None for k in known], dtype=bool)
        known = [k or ("", b"", bytes(4 * len(STATS))) for k in known]
        stats = np.frombuffer(b"".join(k[2] for k in known), dtype="<i4").reshape(-1, len(STATS))
        counts = np.array([len(k[1]) // 4 for k in known], dtype=np.int64)
        spans = np.diff(words.ends)
        broken = np.add.reduceat(dumb[words.index].astype(int), words.ends[:-1]) > 0 if spoken else np.zeros(0, bool)
        stay = np.repeat(~broken, spans)
        index, spans = words.index[stay], spans[~broken]
        place = np.array(spoken, dtype=np.int64)[words.order][~broken]
        ends = np.concatenate([[0], np.cumsum(spans)])
        sums = np.zeros((len(texts), len(STATS)), dtype=np.int64)
        pairs, pair_ends = np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        if not len(place):
            return sums, pa.array([""] * len(texts), type=pa.string()), pairs, pair_ends
        sums[place] = np.add.reduceat(stats[index].astype(np.int64), ends[:-1], axis=0)
        named = pa.array([k[0] for k in known], type=pa.string()).take(pa.array(index))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), named), ";")
        # Back into the order of the texts, nothing where there are no tokens.
        where = np.full(len(texts), -1)
        where[place] = np.arange(len(place))
        groups = pc.fill_null(joined.take(pa.array(where, mask=where < 0)), "")
        by_text = np.argsort(place, kind="stable")
        moved = gathered(index, spans, by_text)
        pairs = gathered(np.frombuffer(b"".join(k[1] for k in known), dtype="<i4"), counts, moved)
        sizes = np.zeros(len(texts), dtype=np.int64)
        sizes[place] = np.add.reduceat(counts[index], ends[:-1])
        return sums, groups, pairs, np.concatenate([[0], np.cumsum(sizes)])


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _group_texts(ids_a, ids_b, group_a, group_b, last_a, last_b) -> list[str]:
    """The groups of each unit: ids of one side joined by commas, sides by ``|``, groups by ``;``."""
    group, side = np.concatenate([group_a, group_b]), np.repeat([0, 1], [len(ids_a), len(ids_b)])
    order = np.lexsort((side, group))  # stable, so the ids of a side stay in order
    ids, group, side = np.concatenate([ids_a, ids_b])[order], group[order], side[order]
    same_group = np.append(np.diff(group) == 0, False)
    same_side = np.append(np.diff(side) == 0, False)
    mark = np.where(same_group, np.where(same_side, 0, 1), 2)
    ends = last_a + last_b
    mark[ends - 1] = 3
    marks = (",", "|", ";", "")
    shown = [f"{i}{marks[m]}" for i, m in zip(ids.tolist(), mark.tolist())]
    return ["".join(shown[x:y]) for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _per_text(pairs: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The distinct pairs of each text and how often each is linked in it."""
    found, times, sizes = [], [], [0]
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        values = np.sort(pairs[a:b])
        starts = np.flatnonzero(np.diff(values, prepend=-1))
        found.append(values[starts])
        times.append(np.diff(starts, append=len(values)).astype(np.int32))
        sizes.append(len(starts))
    offsets = pa.array(np.cumsum(sizes), type=pa.int32())
    none = np.zeros(0, dtype=np.int32)
    return (
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found or [none]), type=pa.int32())),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times or [none]), type=pa.int32())),
    )


def aligned(docs: DataFrame, vocabulary_a: str | None = None, vocabulary_b: str | None = None) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups, pairs, times)``, one row for each row
    of ``docs``.

    The byte-level BPE A reads a space and the text, the sentencepiece model B the text, before which
    it puts a space. ``groups`` lists the ids of both sides between two byte offsets at which both end a
    token; two tokens of a group are linked, and ``n_overlaps`` of the links share bytes. ``pairs`` are
    the distinct linked id pairs, A id times ``PAIR`` plus B id, and ``times`` how often each is linked.

    Null and empty texts have no tokens, nor have those that A's or B's tokens do not give back byte
    for byte: zeros, no groups, no pairs. Rows that repeat an id are documents of their own, other
    columns are left out, no rows give no rows. Texts are worked off by units that no token crosses;
    batches hold a bounded number of bytes or one text.
    """
    path_a, path_b = vocabulary_a or public_path(BYTE_BPE), vocabulary_b or public_path(PIECE_BPE)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = aligner(path_a, path_b)
        for batch in batches:
            for part in slices(batch, "text"):
                sums, groups, pairs, ends = units.of(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *[pa.array(c, type=pa.int64()) for c in sums.T],
                        groups,
                        *_per_text(pairs, ends),
                    ],
                    names=["doc_id", *STATS, "groups", "pairs", "times"],
                )

    counted = ", ".join(f"{c} bigint" for c in STATS)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(align, f"doc_id {kind}, {counted}, groups string, pairs array<int>, times array<int>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many of ``rows`` ``(pairs)`` hold a linked pair, and whether that is the
    highest number among the pairs of its A id, ties included."""
    counted = rows.select(F.explode_outer("pairs").alias("pair")).where(F.col("pair").isNotNull())
    counts = counted.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    # An A id has at most as many partners as B has ids.
    among = Window.partitionBy(F.floor(F.col("pair") / F.lit(PAIR)))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(among)).alias("best"))


def _looked_up(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums over the links of each row, with the counts of all pairs at hand in every worker."""
    held = counts.orderBy("pair").toArrow()
    columns = [held.column(c).to_numpy() for c in ("pair", "n", "best")]
    table = rows.sparkSession.sparkContext.broadcast(columns)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = table.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            ends = pairs.offsets.to_numpy()
            at = np.searchsorted(known, pairs.values.to_numpy()[ends[0] : ends[-1]])
            by = times.values.to_numpy()[times.offsets[0].as_py() : times.offsets[-1].as_py()].astype(np.int64)
            sums = [np.concatenate([[0], np.cumsum(by * x[at])])[ends - ends[0]] for x in (n, best)]
            kept = [batch.column(c) for c in batch.schema.names if c not in ("pairs", "times")]
            made = [pa.array(np.diff(s), type=pa.int64()) for s in sums]
            names = [c for c in batch.schema.names if c not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*names, "count_sum", "n_best"])

    kept = rows.drop("pairs", "times").schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(score, f"{schema}, count_sum bigint, n_best bigint")


def _joined(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The same sums by a join on the pair; frequent pairs are joined where they are."""
    keyed = shared_table(rows.withColumn("_row", F.monotonically_increasing_id()))
    each = keyed.select("_row", F.explode_outer(F.arrays_zip("pairs", "times")).alias("p"))
    flat = each.where(F.col("p").isNotNull()).select("_row", "p.pairs", "p.times").toDF("_row", "pair", "times")
    total = keyed.select(F.coalesce(F.sum(F.size("pairs")), F.lit(0))).scalar()
    sums = join_counted(flat, counts, "pair", total).groupBy("_row").agg(
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        F.sum(F.col("times") * F.col("best").cast("bigint")).alias("n_best"),
    )
    nothing = {"count_sum": 0, "n_best": 0}
    return keyed.drop("pairs", "times").join(sums, "_row", "left").fillna(nothing).drop("_row")


def scored(rows: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``rows`` ``(pairs, times, ...)``, a written table, with ``count_sum``, the sum of the links' corpus-wide
    counts, and ``n_best``, how many links have the highest count of their A id, instead of the two lists.

    The counts are counted first: up to ``broadcast_pairs`` pairs go to every worker, more are joined.
    """
    counts = shared_table(pair_counts(rows))
    if counts.count() <= broadcast_pairs:
        return _looked_up(rows, counts)
    return _joined(rows, counts)


def alignment_table(
    docs: DataFrame,
    vocabulary_a: str | None = None,
    vocabulary_b: str | None = None,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """``aligned`` with a digest in place of the groups (empty without tokens) and the sums of ``scored``.
    Groups become digests before anything is written."""
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    rows = aligned(docs, vocabulary_a, vocabulary_b).withColumn("groups_sha256", digest).drop("groups")
    result = scored(shared_table(rows), broadcast_pairs)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]
    return result.select("doc_id", *columns)
