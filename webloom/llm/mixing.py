"""Rates for documents so that the tokens of each domain meet target weights."""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import bounded_sample, map_batches, one_of_each, shared_table, unit_hash
from webloom.llm.features import STATISTICS, fit_softmax, only, sampled_rows, softmax, telling, text_features

BITS = 16
SIZE = (1 << BITS) + 2
# Documents of each domain that the classifier learns from (about; all, if there are fewer).
TRAIN_ROWS = 2500
# Share of the tokens that each domain of the labelled table should have.
TARGETS = {"clean": 0.9, "junk": 0.05, "toxic": 0.05}
# Bound that a caller may set on the rate of a document; the query has none.
MAX_RATE = 4.0
ITERATIONS = 40
TOLERANCE = 1e-4
log = logging.getLogger(__name__)


def domain() -> Column:
    """The domain of a labelled document; a null label says nothing."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), "clean"
    )


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray  # (domains, features + 1)


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Classifier:
    """Multinomial logistic regression on a bounded sample of each domain, weighted back to the
    domains' shares. Without labels all domains are equally likely."""
    known = labels.where(F.col("doc_id").isNotNull()).select("doc_id", domain().alias("domain"))
    known = known.where(F.col("domain").isNotNull())
    # At most train_rows rows, or thereabouts, for each of the domains.
    sample = F.broadcast(bounded_sample(known, "doc_id", train_rows, "domain"))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(sample, "doc_id")
    texts = one_of_each(texts.select("doc_id", "text", "domain", "share"), "doc_id")
    rows, table = sampled_rows(texts, BITS, ["domain", "share"])
    names = list(TARGETS)
    label = table["domain"].map({d: i for i, d in enumerate(names)}).to_numpy(dtype=np.int64)
    tells = np.any([telling(rows, label == i, SIZE) for i in range(len(names))], axis=0)
    tells[-STATISTICS:] = True
    rows = only(rows, tells)
    weight = 1.0 / table["share"].to_numpy(dtype=np.float64)
    return Classifier(names, fit_softmax(rows, label, weight, len(names), SIZE))


def posteriors(docs: DataFrame, model: Classifier, carry: list[str]) -> DataFrame:
    """Columns ``carry`` with ``tokens`` (words between white space) and ``p``, the probability of each
    domain; a text without words has no tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(  # domains times SIZE
        (model.weights[:, :-1].T.astype(np.float32), model.weights[:, -1])
    )

    def compute(batch: pa.RecordBatch) -> list:
        weights, intercept = shared.value
        texts = [text or "" for text in batch.column("text").to_pylist()]
        made = [text_features(text, BITS) for text in texts]
        scores = np.array([v @ weights[n] + intercept for n, v in made]).reshape(len(made), len(intercept))
        return [[len(t.encode("utf-8", "replace").split()) for t in texts], list(softmax(scores))]

    source = docs.select(*carry, "text")
    return map_batches(source, carry, "tokens bigint, p array<double>", compute)


def rate(steps: list[list[float]], max_rate: float) -> Column:
    """The rate of a document after the given steps: from 1, each step subtracts the step's value for
    the document's domains, and the result is cut to ``[0, max_rate]``."""
    if not steps:
        return F.lit(1.0)
    history = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])

    def move(r: Column, step: Column) -> Column:
        change = F.aggregate(F.zip_with("p", step, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return F.least(F.lit(float(max_rate)), F.greatest(F.lit(0.0), r - change))

    return F.aggregate(history, F.lit(1.0), move)


def fit_rates(
    table: DataFrame,
    targets: list[float],
    total: float | None = None,
    max_rate: float = MAX_RATE,
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
) -> tuple[list[list[float]], list[float]]:
    """Steps of the projected-gradient fit, and the residual tokens of each domain, as shares.

    ``table`` (tokens, p) is read once in each iteration, in tasks; the driver sees sums for each
    domain alone. Minimised is the squared distance of the expected tokens of each domain,
    sum(rate * tokens * p), from ``total * target``, over rates in ``[0, max_rate]``, from rates of 1.
    A gradient step moves a rate by the document's p times the residuals, scaled by the inverse of the
    second moments of the tokens whose rate is above 0, which makes a step of size one exact while no
    rate meets a bound. As a rate follows from p and the steps taken, no rates are stored. A step that
    does not lower the distance is halved, one that does doubles the next up to eight. The fit ends at
    the tolerance, or where no step helps; then the residuals tell what is missed.
    """
    d = len(targets)
    tokens, p = F.col("tokens"), F.col("p")
    base = float(table.agg(F.sum("tokens")).first()[0] or 0.0)
    if not base:
        return [], [0.0] * d
    goal = np.array(targets) / sum(targets) * ((total if total is not None else base) / base)

    def after(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        """Residuals, and second moments of the tokens that a step can lower as well as raise."""
        rated = table.select("tokens", "p", rate(steps, max_rate).alias("r"))
        free = F.when(F.col("r") > 0, tokens).otherwise(0)
        sums = rated.agg(
            *[F.sum(F.col("r") * tokens * p[i]) for i in range(d)],
            *[F.sum(free * p[i] * p[j]) for i in range(d) for j in range(d)],
        ).first()
        values = np.array([float(x) for x in sums]) / base
        return values[:d] - goal, values[d:].reshape(d, d)

    def scale(moment: np.ndarray) -> np.ndarray:
        return np.linalg.inv(moment + 1e-6 * max(np.trace(moment), 1e-9) * np.eye(d))

    steps: list[list[float]] = []
    (residual, moment), size = after(steps), 1.0
    for _ in range(iterations):
        if np.abs(residual).max() <= tolerance or size < 1e-4:
            break
        tried = [*steps, (size * (scale(moment) @ residual)).tolist()]
        new, new_moment = after(tried)
        gain = 1 - (new @ new) / (residual @ residual)
        if gain <= 0:
            size /= 2
            continue
        if gain < 1e-6 and size <= 1:
            break
        steps, residual, moment, size = tried, new, new_moment, 1.0 if gain < 1e-3 else min(8.0, 2 * size)
    return steps, residual.tolist()


def missed(residual: list[float], names: list[str], tolerance: float = TOLERANCE) -> dict[str, float]:
    """The domains whose share is not met, with what is too much of them, or below 0 too little."""
    gaps = {name: gap for name, gap in zip(names, residual) if abs(gap) > tolerance}
    if gaps:
        log.warning("targets missed, as shares of all tokens: %s", gaps)
    return gaps


def mixture(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    max_rate: float = math.inf,
) -> tuple[DataFrame, dict[str, float]]:
    """The table of ``mix``, and the domains whose target is missed (see ``missed``)."""
    table = shared_table(posteriors(docs, train(docs, labels), ["doc_id"]))
    steps, residual = fit_rates(table, [targets[d] for d in TARGETS], max_rate=max_rate)
    rated = table.withColumn("rate", F.round(rate(steps, max_rate), 6))
    mixed = rated.select(
        "doc_id",
        "tokens",
        *[F.round(F.col("p")[i], 6).alias(f"p_{d}") for i, d in enumerate(TARGETS)],
        "rate",
        copies(F.col("rate"), F.col("doc_id")).alias("copies"),
    )
    return mixed, missed(residual, list(TARGETS))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    max_rate: float = math.inf,
) -> DataFrame:
    """``(doc_id, tokens, p_clean, p_junk, p_toxic, rate, copies)`` for every row of ``docs``.

    ``rate`` is the expected number of times the document is taken, ``copies`` a whole number that a
    hash of its id draws with that expectation. Null, empty and blank texts have no tokens; their
    rate follows from the domain of an empty text, as any other's. A null id draws as one value. Missed
    targets are logged; ``mixture`` returns them."""
    return mixture(docs, labels, targets, max_rate)[0]


def copies(expected: Column, key: Column) -> Column:
    """A whole number near ``expected`` that comes out right on average."""
    return (F.floor(expected) + (unit_hash(key) < expected - F.floor(expected)).cast("int")).cast("int")


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs`` after mixing without repetition: rates end at 1 and the budget is what
    lets the first domain of ``targets`` stay whole, so the others give way to its target share."""
    model = train(docs, labels)
    table = shared_table(posteriors(docs, model, ["doc_id"]))
    names = list(targets)
    first = table.agg(F.sum(F.col("tokens") * F.col("p")[0])).first()[0] or 0.0
    # Two per cent above what there is, so that documents of the first domain are not thinned.
    budget = 1.02 * first * sum(targets.values()) / targets[names[0]]
    steps, residual = fit_rates(table, [targets[d] for d in names], budget, max_rate=1.0)
    missed(residual, names)
    taken = copies(F.round(rate(steps, 1.0), 6), F.col("doc_id"))
    gone = table.where((taken == 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
