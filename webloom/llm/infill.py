"""Fill-in-middle examples: texts cut at unit boundaries that a Fenwick tree over text blocks finds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import slices

SEED = 7
# Of 100 documents, so many are rearranged, and so many of those put the suffix first.
RATE = 100
SUFFIX_FIRST = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Bytes of a text block, the leaf of the tree.
BLOCK = 1024
NEWLINE = 10


class BlockTree:
    """Fenwick tree over blocks of ``BLOCK`` bytes of a buffer of UTF-8 texts.

    Each node sums the line feeds and the code points of a run of blocks, so the block in which the
    k-th line feed lies is found by a descent through the powers of two, for many k at once, and only
    that block is searched byte by byte. Code points are counted where they begin: at bytes that
    continue no other.
    """

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        self.data, self.block = data, block
        starts = np.arange(0, len(data), block)
        self.blocks = len(starts)
        self.counts = np.zeros((2, self.blocks + 1), dtype=np.int64)
        if self.blocks:
            # One mask lives at a time.
            self.counts[0, 1:] = np.add.reduceat(data == NEWLINE, starts, dtype=np.int64)
            self.counts[1, 1:] = np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)
        # Node i sums the blocks of (i - lowest bit of i, i].
        sums = np.cumsum(self.counts, axis=1)
        node = np.arange(self.blocks + 1)
        self.tree = sums[:, node] - sums[:, node - (node & -node)]

    def before(self, kind: int, at: np.ndarray) -> np.ndarray:
        """Line feeds (0) or code points (1) before the byte offsets ``at``."""
        node = at // self.block
        total = np.zeros(len(at), dtype=np.int64)
        while node.any():
            total += self.tree[kind, node]
            node = node - (node & -node)
        for i, offset in enumerate(at.tolist()):
            part = self.data[offset - offset % self.block : offset]
            total[i] += np.count_nonzero(part == NEWLINE if kind == 0 else (part & 0xC0) != 0x80)
        return total

    def after_line_feed(self, k: np.ndarray) -> np.ndarray:
        """Byte offset behind the k-th line feed of the buffer (from 1; it must exist)."""
        node = np.zeros(len(k), dtype=np.int64)
        left = k.astype(np.int64).copy()
        step = 1 << max(self.blocks.bit_length() - 1, 0)
        while step:
            further = np.minimum(node + step, self.blocks)
            fits = (node + step <= self.blocks) & (self.tree[0, further] < left)
            left -= np.where(fits, self.tree[0, further], 0)
            node += np.where(fits, step, 0)
            step >>= 1
        places = np.empty(len(k), dtype=np.int64)
        for i, (block, nth) in enumerate(zip(node.tolist(), left.tolist())):
            start = block * self.block
            local = np.flatnonzero(self.data[start : start + self.block] == NEWLINE)
            places[i] = start + local[nth - 1] + 1
        return places


def cut_points(
    data: np.ndarray, ends: np.ndarray, draws: np.ndarray, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units, cut bytes and cut code points of texts that follow each other in ``data``.

    ``ends`` holds the texts' byte offsets, from 0. ``draws`` (texts x 2) are random integers: modulo
    units + 1 they say after how many units to cut. Returned are the number of units, and (texts x 2)
    the byte offsets of both cuts, the smaller one first, and the code points from the text's start
    to each of them.
    """
    tree = BlockTree(data, block)
    start, end = ends[:-1], ends[1:]
    feeds = tree.before(0, ends)
    filled = end > start
    open_end = np.zeros(len(start), dtype=bool)
    open_end[filled] = data[end[filled] - 1] != NEWLINE
    units = np.diff(feeds) + open_end
    after = np.sort(draws % (units + 1)[:, None], axis=1)
    cuts = np.where(after == 0, start[:, None], end[:, None])
    inside = (after > 0) & (after < units[:, None])
    wanted = (feeds[:-1, None] + after)[inside]
    cuts[inside] = tree.after_line_feed(wanted)
    points = tree.before(1, np.concatenate([start, cuts.ravel()]))
    first, rest = points[: len(start)], points[len(start) :].reshape(cuts.shape)
    return units, cuts, rest - first[:, None]


def _draws(doc_id: Column, seed: int) -> Column:
    """Four 32-bit numbers from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)])


def rearranged(
    docs: DataFrame,
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row for each row of ``docs``.

    A text of ``n`` lines, each with its line feed, is cut after two drawn numbers of lines into
    prefix, middle and suffix. ``form`` says how ``output`` is put together: ``psm``, ``spm`` or, for
    texts that are empty, hold a marker or are not drawn, ``plain``, which is the text itself. The
    numbers of code points are null then. Draws depend on seed and id alone.

    A null text counts as empty; a null id is drawn like an empty one. Rows that repeat an id are cut
    by the same draws, each on its own text. Other columns are left out, whatever their names. No
    rows give no rows. Texts are never split over tasks, batches of them hold a bounded number of
    bytes or one text.
    """
    schema = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _draws(F.col("doc_id"), seed).alias("h"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _arranged(part, rate, suffix_first, block)

    return rows.mapInArrow(
        cut, f"doc_id {schema}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def _arranged(part: pa.RecordBatch, rate: int, suffix_first: int, block: int) -> pa.RecordBatch:
    texts = part.column("text").cast(pa.large_binary())
    raw = texts.to_pylist()
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)])
    h = part.column("h").flatten().to_numpy().reshape(-1, 4)
    units, cuts, points = cut_points(data, ends, h[:, :2], block)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    forms, outputs = [], []
    for i, text in enumerate(raw):
        if not text or h[i, 2] % 100 >= rate or any(mark in text for mark in marks):
            forms.append("plain")
            outputs.append(text)
            continue
        a, b = (cuts[i] - ends[i]).tolist()
        if h[i, 3] % 100 < suffix_first:
            forms.append("spm")
            outputs.append(b"".join((s, text[b:], p, text[:a], m, text[a:b])))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, text[:a], s, text[b:], m, text[a:b])))
    plain = np.array([f == "plain" for f in forms], dtype=bool)
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array(units, type=pa.int64()),
            pa.array(forms, type=pa.string()),
            pa.array(points[:, 0], type=pa.int64(), mask=plain),
            pa.array(points[:, 1] - points[:, 0], type=pa.int64(), mask=plain),
            pa.array(outputs, type=pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def restored(form: Column, output: Column) -> Column:
    """The text from an output and its form. A rearranged text holds no marker, and pieces of it beside
    a marker make none, so each marker occurs once."""
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    second, first = F.lit(2), F.lit(1)
    middle = F.split_part(output, m, second)
    front = F.split_part(output, m, first)
    psm = F.concat(
        F.split_part(F.split_part(front, s, first), p, second), middle, F.split_part(front, s, second)
    )
    spm = F.concat(
        F.split_part(front, p, second), middle, F.split_part(F.split_part(front, p, first), s, second)
    )
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(examples: DataFrame) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)`` of ``rearranged``."""
    return examples.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )
