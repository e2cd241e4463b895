"""Quality rules: base statistics of documents and a gradient-boosted verdict on them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import bounded_sample, map_batches, one_of_each, plain, shared_table
from webloom.llm.features import SYMBOLS, sigmoid

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
# Documents of each label that the trees learn from (about; all, if there are fewer).
TRAIN_ROWS = 10_000
TREES = 30
DEPTH = 3
BINS = 32
RATE = 0.2
LEAST_LEAF = 20
# Features with the direction in which quality may move as they grow: down, up, or free.
FEATURES = {"symbols": -1, "duplicate_lines": -1, "repeated": -1, "distinct": 1, "line_words": 0, "word_length": 0}
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def statistics(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """Words, code points in words, symbols, lines with a word that repeat an earlier line, words in
    8-word windows found at least twice; then distinct words and lines with a word. Null has none."""
    if not text:
        return 0, 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # of bytes: at space, tab, line feed, vertical tab, form feed and return
    chars = len(b"".join(words).decode("utf-8", "replace"))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    return (
        len(words),
        chars,
        sum(raw.count(s) for s in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(number),
        len(lines),
    )


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more. Windows get exact numbers by pairing the numbers
    of their halves, so ``window`` is a power of two."""
    if len(ids) < window + 1:
        return 0
    width, counts = 1, None
    while width < window:
        pairs = ids[:-width] * len(ids) + ids[width:]
        _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        width *= 2
        if counts.max() < 2:
            return 0
    again = np.flatnonzero(counts[ids] > 1)
    edges = np.zeros(len(ids) + window, dtype=np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def base_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_distinct, n_lines)``."""

    def compute(batch: pa.RecordBatch) -> list:
        rows = [statistics(text) for text in batch.column("text").to_pylist()]
        return [list(column) for column in zip(*rows)] if rows else [[]] * 7

    return map_batches(
        docs.select("doc_id", "text"), ["doc_id"], f"{BASE}, n_distinct bigint, n_lines bigint", compute
    )


def features() -> Column:
    """The statistics as shares, in the order of ``FEATURES``."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return F.array(
        F.col("n_symbols") / words,
        F.col("n_dup_lines") / lines,
        F.col("n_repeat_words") / words,
        # Long texts repeat their common words, so the distinct ones are held against a power.
        F.least(F.lit(1.0), F.col("n_distinct") / F.pow(words, F.lit(0.7))),
        F.least(F.lit(200.0), F.col("n_words") / lines),
        F.col("word_chars") / words,
    )


@dataclass
class Forest:
    """Trees in flat arrays, one row for each tree. Node 0 is the root; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of each row of ``x``. All rows step down all trees at once; a
        value up to the threshold goes left."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[t, node]] <= self.threshold[t, node]
                node = np.where(goes_left, self.left[t, node], self.right[t, node])
            total += self.value[t, node]
        return sigmoid(total)


def boost(
    x: np.ndarray,
    good: np.ndarray,
    weight: np.ndarray,
    direction: list[int],
    trees: int = TREES,
    depth: int = DEPTH,
    least_leaf: int = LEAST_LEAF,
) -> Forest:
    """Gradient boosting of the logistic loss with histogram splits. A split on a feature with a
    direction must order its leaves that way, and what lies below stays on its side of the middle, so
    the whole score is monotonic in the feature. Ties go to the first feature and lowest threshold."""
    n, columns = x.shape
    nodes = 2 ** (depth + 1) - 1
    forest = Forest(
        *(np.zeros((trees, nodes), dtype=k) for k in (np.int64, np.float64, np.int64, np.int64, np.float64)),
        0.0,
        depth,
    )
    own = np.broadcast_to(np.arange(nodes), (trees, nodes))
    forest.left, forest.right = own.copy(), own.copy()
    if not n:
        return forest
    share = np.clip((weight * good).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    forest.start = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, BINS + 1)[1:-1])) for c in range(columns)]
    binned = np.stack([np.searchsorted(cuts[c], x[:, c]) for c in range(columns)], axis=1)
    total = np.full(n, forest.start)
    for t in range(trees):
        p = sigmoid(total)
        slope, curve = weight * (good - p), weight * np.maximum(p * (1 - p), 1e-6)
        jobs = [(0, np.arange(n), -np.inf, np.inf, depth)]
        while jobs:
            node, rows, low, high, left_depth = jobs.pop()
            at = float(np.clip(slope[rows].sum() / (curve[rows].sum() + 1.0), low, high))
            forest.value[t, node] = RATE * at
            best = _best_split(binned[rows], slope[rows], curve[rows], cuts, direction, low, high, least_leaf) if left_depth else None
            if best is None:
                total[rows] += RATE * at
                continue
            c, b, below, above = best
            forest.feature[t, node], forest.threshold[t, node] = c, cuts[c][b]
            forest.left[t, node], forest.right[t, node] = 2 * node + 1, 2 * node + 2
            middle = (below + above) / 2
            goes_left = binned[rows, c] <= b
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            (a1, a2), (b1, b2) = bounds.get(direction[c], ((low, high), (low, high)))
            jobs += [
                (2 * node + 1, rows[goes_left], a1, a2, left_depth - 1),
                (2 * node + 2, rows[~goes_left], b1, b2, left_depth - 1),
            ]
    return forest


def _best_split(binned, slope, curve, cuts, direction, low, high, least_leaf):
    best, gain = None, 1e-6
    whole = slope.sum() ** 2 / (curve.sum() + 1.0)
    for c in range(binned.shape[1]):
        if not len(cuts[c]):
            continue
        size = len(cuts[c]) + 1
        s = np.cumsum(np.bincount(binned[:, c], slope, size))
        h = np.cumsum(np.bincount(binned[:, c], curve, size))
        k = np.cumsum(np.bincount(binned[:, c], minlength=size))
        below = np.clip(s[:-1] / (h[:-1] + 1.0), low, high)
        above = np.clip((s[-1] - s[:-1]) / (h[-1] - h[:-1] + 1.0), low, high)
        fits = (k[:-1] >= least_leaf) & (k[-1] - k[:-1] >= least_leaf) & ((above - below) * direction[c] >= 0)
        worth = s[:-1] ** 2 / (h[:-1] + 1.0) + (s[-1] - s[:-1]) ** 2 / (h[-1] - h[:-1] + 1.0) - whole
        worth = np.where(fits, worth, -np.inf)
        b = int(np.argmax(worth))
        if worth[b] > gain:
            best, gain = (c, b, float(below[b]), float(above[b])), worth[b]
    return best


def train(table: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Forest:
    """Trees learnt from the statistics of a bounded sample of each label; labels of unknown documents
    and null labels are passed over."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    # At most train_rows rows, or thereabouts, for each of the two labels.
    sample = F.broadcast(bounded_sample(known.select("doc_id", "quality"), "doc_id", train_rows, "quality"))
    rows = table.join(sample, "doc_id").select(
        "doc_id", features().alias("x"), "quality", (1.0 / F.col("share")).alias("w")
    )
    got = one_of_each(rows, "doc_id").orderBy("doc_id").toPandas()
    x = np.array(got["x"].tolist(), dtype=np.float64).reshape(len(got), len(FEATURES))
    good = got["quality"].to_numpy(dtype=np.float64)
    return boost(x, good, got["w"].to_numpy(dtype=np.float64), list(FEATURES.values()))


def judge(docs: DataFrame, labels: DataFrame, least: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    p_good)`` for every row of ``docs``; ``p_good`` is the trees' probability of a good document.

    The base rules fail a document of fewer than 20 words, or with over 30 % of its words in repeated
    windows. Others are kept if the trees find them good with a probability of ``least``. Null and
    empty texts have no words and fail. Without labels the trees find everything even and keep it.
    """
    table = shared_table(base_table(docs))
    shared = docs.sparkSession.sparkContext.broadcast(plain(train(table, labels, train_rows)))

    def score(batch: pa.RecordBatch) -> list:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        return [Forest(*shared.value).score(x)]

    base = [f.split()[0] for f in BASE.split(", ")]
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    scored = map_batches(table.withColumn("x", features()), ["doc_id", *base], "p_good double", score)
    return scored.select(
        "doc_id",
        *base,
        failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= least)).alias("kept"),
        F.round("p_good", 9).alias("p_good"),
    )
