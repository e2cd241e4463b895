"""Sparse text features and the gradient fits that the classifiers share (numpy, inside tasks; the
fits see bounded samples only)."""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from webloom.llm.common import lists_of, map_batches

# Characters that make up a stem feature.
STEM = 5
# Features after the hashed ones: symbols for each word, share of repeated words.
STATISTICS = 2
SYMBOLS = b"#*$%&|<>"


def words_of(text: str) -> list[bytes]:
    """Lower-cased words without punctuation around them."""
    return [w for w in (w.strip(b".,;:!?\"'()") for w in text.lower().encode("utf-8", "replace").split()) if w]


def text_features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text: logarithms of the counts of its words and word stems,
    hashed to ``2 ** bits`` numbers, and two statistics. No words, no features."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32)
    n = len(words)
    whole = np.fromiter(map(crc32, words), dtype=np.uint32, count=n)
    stems = np.fromiter((crc32(w[:STEM], 1) for w in words), dtype=np.uint32, count=n)
    numbers, counts = np.unique(np.concatenate([whole, stems]) >> np.uint32(32 - bits), return_counts=True)
    raw = text.encode("utf-8", "replace")
    symbols = sum(raw.count(s) for s in SYMBOLS)
    repeated = 1.0 - len(np.unique(whole)) / n
    extra = np.array([min(5.0, 5.0 * symbols / n), 5.0 * repeated], dtype=np.float32)
    base = 1 << bits
    return (
        np.concatenate([numbers.astype(np.int64), [base, base + 1]]),
        np.concatenate([np.log1p(counts).astype(np.float32), extra]),
    )


@dataclass
class Rows:
    """Sparse rows: feature numbers, values, and the row of each of them."""

    numbers: np.ndarray
    values: np.ndarray
    row: np.ndarray
    n: int

    @staticmethod
    def of(features: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        sizes = [len(f[0]) for f in features]
        join = lambda i, kind: np.concatenate([np.asarray(f[i], dtype=kind) for f in features] or [np.zeros(0, kind)])
        return Rows(join(0, np.int64), join(1, np.float32), np.repeat(np.arange(len(sizes)), sizes), len(sizes))

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Scores of all rows for one weight vector."""
        return np.bincount(self.row, weights=self.values * weights[self.numbers], minlength=self.n)

    def back(self, slope: np.ndarray, size: int) -> np.ndarray:
        """Gradient of the weights for the slope of each row's score."""
        return np.bincount(self.numbers, weights=self.values * slope[self.row], minlength=size)


# Documents that a feature must stand in, and how many standard errors its share must differ between
# the documents with and without a label, to be learnt from.
LEAST_ROWS = 8
LEAST_Z = 5.0


def telling(rows: Rows, marked: np.ndarray, size: int) -> np.ndarray:
    """Which features say something about a label. Words that are in a few documents only, as most of
    a large vocabulary are, would be learnt by heart."""
    ones, others = max(1, int(marked.sum())), max(1, int((~marked).sum()))
    there = np.bincount(rows.numbers[marked[rows.row]], minlength=size)
    elsewhere = np.bincount(rows.numbers[~marked[rows.row]], minlength=size)
    pooled = (there + elsewhere) / (ones + others)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / ones + 1 / others))
    z = np.abs(there / ones - elsewhere / others) / error
    return (z >= LEAST_Z) & (there + elsewhere >= LEAST_ROWS)


def only(rows: Rows, features: np.ndarray) -> Rows:
    """The rows with a choice of features."""
    keep = features[rows.numbers]
    return Rows(rows.numbers[keep], rows.values[keep], rows.row[keep], rows.n)


def sampled_rows(sample: DataFrame, bits: int, columns: list[str]) -> tuple[Rows, pd.DataFrame]:
    """The sparse rows of a bounded sample of texts, computed in tasks, and its other columns."""

    def compute(batch: pa.RecordBatch) -> list:
        made = [text_features(text or "", bits) for text in batch.column("text").to_pylist()]
        return [[m[0] for m in made], [m[1] for m in made]]

    parts = sample.sparkSession.sparkContext.defaultParallelism
    spread = sample.repartition(parts, "doc_id")
    made = map_batches(spread, ["doc_id", *columns], "numbers array<int>, vals array<float>", compute)
    table = made.toArrow().sort_by("doc_id").combine_chunks()
    if not len(table):
        return Rows.of([]), table.select(["doc_id", *columns]).to_pandas()
    batch = table.to_batches()[0]
    rows = Rows.of(list(zip(lists_of(batch, "numbers"), lists_of(batch, "vals"))))
    return rows, table.select(["doc_id", *columns]).to_pandas()


def adam(start: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    """Minimise by ``steps`` full-batch steps of Adam with a falling rate."""
    at, mean, square = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(at)
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        step = rate * (1 - t / (steps + 1))
        at -= step * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return at


def fit_softmax(rows: Rows, label: np.ndarray, weight: np.ndarray, classes: int, size: int, steps: int = 200, l2: float = 1e-5) -> np.ndarray:
    """Multinomial logistic regression: ``(classes, size + 1)`` weights, the last one the intercept."""
    target = np.eye(classes)[label] if len(label) else np.zeros((0, classes))
    share = weight / max(weight.sum(), 1e-12)

    def gradient(flat: np.ndarray) -> np.ndarray:
        w = flat.reshape(classes, size + 1)
        scores = np.stack([rows.times(w[k, :size]) + w[k, size] for k in range(classes)], axis=1)
        slope = (softmax(scores) - target) * share[:, None]
        g = np.empty_like(w)
        for k in range(classes):
            g[k, :size] = rows.back(slope[:, k], size) + l2 * w[k, :size]
            g[k, size] = slope[:, k].sum()
        return g.reshape(-1)

    return adam(np.zeros(classes * (size + 1)), gradient, steps, 0.1).reshape(classes, size + 1)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    return e / e.sum(axis=1, keepdims=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
