"""Severity of toxic language by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import bounded_sample, map_batches, one_of_each
from webloom.llm.features import Rows, adam, only, sampled_rows, sigmoid, telling, text_features

BITS = 18
SIZE = (1 << BITS) + 2
# Documents of each label that the model learns from (about; all, if there are fewer).
TRAIN_ROWS = 4000
# Grades: none, and three of ever more toxic words.
GRADES = 4
STEPS = 300
RATE = 0.1
L2 = 2e-6


@dataclass
class Ordinal:
    """``P(grade <= k) = sigmoid(thresholds[k] - weights . x)``: one weight for each feature, shared by
    all thresholds, which rise."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """Probabilities of grade 1 and up, grade 2 and up, ..."""
        return sigmoid(np.asarray(score)[:, None] - self.thresholds[None, :])


def fit_ordinal(
    rows: Rows, grade: np.ndarray, weight: np.ndarray, grades: int, size: int, steps: int = STEPS, l2: float = L2
) -> Ordinal:
    """Minimise the negative log likelihood by full-batch steps. The thresholds are the first one and
    the logarithms of the gaps to the next, so they stay in order."""
    share = weight / max(weight.sum(), 1e-12)
    present = np.array([share[grade > k].sum() for k in range(grades - 1)])
    odds = np.log((1 - present + 1e-3) / (present + 1e-3))
    gaps = np.maximum(np.diff(odds), 0.1)
    start = np.concatenate([np.zeros(size), odds[:1], np.log(gaps)])

    def thresholds(free: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))

    def gradient(at: np.ndarray) -> np.ndarray:
        theta = thresholds(at[size:])
        score = rows.times(at[:size])
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        high, low = edge[grade + 1] - score, edge[grade] - score
        # With p = sigmoid(high) - sigmoid(low) = sigmoid(high) sigmoid(-low) (1 - exp(low - high)), the
        # slopes of -log p stay finite and do not vanish however wrong a score is.
        gap = np.concatenate([[0.0], 1 / np.expm1(np.diff(theta)), [0.0]])[grade]
        up, down = share * (sigmoid(-high) + gap), share * (sigmoid(low) + gap)
        g_theta = np.array([down[grade == k + 1].sum() - up[grade == k].sum() for k in range(grades - 1)])
        g = np.empty_like(at)
        g[:size] = rows.back(up - down, size) + l2 * at[:size]
        below = np.cumsum(g_theta[::-1])[::-1]
        g[size] = below[0]
        g[size + 1 :] = below[1:] * np.exp(at[size + 1 :])
        return g

    best = adam(start, gradient, steps, RATE) if rows.n else start
    return Ordinal(best[:size], thresholds(best[size:]))


def grade_toxic(rows: Rows, toxic: np.ndarray, grades: int) -> np.ndarray:
    """Grades of labelled documents: 0 without the label; with it 1 and up, by how much of the telling
    features the document holds, cut at equal parts of the labelled documents."""
    if not toxic.any():
        return np.zeros(rows.n, dtype=np.int64)
    tells = telling(rows, toxic, SIZE)
    seen = np.bincount(rows.numbers[toxic[rows.row]], minlength=SIZE) / toxic.sum()
    other = np.bincount(rows.numbers[~toxic[rows.row]], minlength=SIZE) / max(1, (~toxic).sum())
    bad = tells & (seen > 10 * other)
    mass = np.bincount(rows.row, weights=rows.values * bad[rows.numbers], minlength=rows.n)
    cuts = np.quantile(mass[toxic], np.arange(1, grades - 1) / (grades - 1))
    return np.where(toxic, 1 + np.searchsorted(cuts, mass, side="left"), 0)


def train(docs: DataFrame, labels: DataFrame, grades: int = GRADES, train_rows: int = TRAIN_ROWS) -> Ordinal:
    """Learn from a bounded sample of each label; null labels and documents without text teach
    nothing."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    # At most train_rows rows, or thereabouts, for each of the two labels.
    sample = F.broadcast(bounded_sample(known.select("doc_id", "toxic"), "doc_id", train_rows, "toxic"))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(sample, "doc_id")
    texts = one_of_each(texts.select("doc_id", "text", "toxic", "share"), "doc_id")
    rows, table = sampled_rows(texts, BITS, ["toxic", "share"])
    toxic = table["toxic"].to_numpy(dtype=np.int64) > 0
    grade = grade_toxic(rows, toxic, grades)
    rows = only(rows, telling(rows, toxic, SIZE))
    return fit_ordinal(rows, grade, 1.0 / table["share"].to_numpy(dtype=np.float64), grades, SIZE)


def severity(docs: DataFrame, model: Ordinal) -> DataFrame:
    """``(doc_id, severity, grade, p_toxic, toxic)`` for every row of ``docs``: the expected grade, the
    most probable grade (the lower one of equals), the probability of any grade above 0, and whether
    that is at least a half. Null, empty and wordless texts are not toxic: 0, 0, 0, false."""
    kept = np.flatnonzero(model.weights)
    shared = docs.sparkSession.sparkContext.broadcast(  # at most SIZE features
        (kept.astype(np.int32), model.weights[kept].astype(np.float32), model.thresholds)
    )

    def compute(batch: pa.RecordBatch) -> list:
        numbers, weights, thresholds = shared.value
        dense = np.zeros(SIZE, dtype=np.float32)
        dense[numbers] = weights
        made = [text_features(text or "", BITS) for text in batch.column("text").to_pylist()]
        score = np.array([float(dense[n] @ v) for n, v in made])
        above = Ordinal(dense, thresholds).at_least(score)
        above[[not len(n) for n, _ in made]] = 0.0
        exactly = -np.diff(np.concatenate([np.ones((len(made), 1)), above, np.zeros((len(made), 1))], axis=1))
        return [above.sum(axis=1), exactly.argmax(axis=1), above[:, 0], above[:, 0] >= 0.5]

    new = "severity double, grade int, p_toxic double, toxic boolean"
    scored = map_batches(docs.select("doc_id", "text"), ["doc_id"], new, compute)
    return scored.select(
        "doc_id", F.round("severity", 6).alias("severity"), "grade", F.round("p_toxic", 6).alias("p_toxic"), "toxic"
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Severity of every row of ``docs`` by a model learnt from the labelled ones; without labels
    nothing is toxic."""
    return severity(docs, train(docs, labels))
