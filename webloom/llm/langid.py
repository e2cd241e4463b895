"""Language of texts by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import MAX_LABELS, bounded_sample, keep_rows, map_batches, plain

ORDERS = (1, 2, 3)
BITS = 13
# Documents of each language that the model learns from (about; all, if there are fewer).
TRAIN_ROWS = 5000
# Tasks that count n-grams of the sample.
TRAIN_PARTS = 16
UNKNOWN = "und"
# Characters of a text that are hashed at a time.
PIECE = 1 << 18


def buckets(text: str, orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> Iterator[np.ndarray]:
    """Bucket numbers of all character n-grams of a text, in pieces of bounded size."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    down = np.uint32(32 - bits)
    reach = max(orders) - 1
    for start in range(0, len(codes), PIECE):
        piece = codes[start : start + PIECE + reach]
        last = min(PIECE, len(codes) - start)
        rolled = np.zeros(len(piece), dtype=np.uint32)
        for n in range(1, max(orders) + 1):
            if n > len(piece):
                break
            rolled = rolled[: len(piece) - n + 1] * np.uint32(0x01000193) + piece[n - 1 :]
            if n in orders:
                salted = (rolled + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                salted ^= salted >> np.uint32(15)
                yield ((salted * np.uint32(0xC2B2AE35)) >> down)[:last]


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray  # (buckets, languages)

    def posterior(self, text: str) -> np.ndarray:
        score = self.log_prior.copy()
        for numbers in buckets(text):
            counts = np.bincount(numbers, minlength=len(self.log_probability))
            score += counts @ self.log_probability
        e = np.exp(score - score.max())
        return e / e.sum()


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without an id is not held out, nor learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from ``text`` and ``lang`` of a bounded sample of each language; rows without id, text or
    language, and rows that are held out, are not looked at. The n-grams are counted in tasks; the
    driver gets one number for each bucket and language."""
    ours = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    rows = docs.select("doc_id", "lang", "text").where(ours & ~held_out(F.col("doc_id")))
    sample = bounded_sample(rows, "doc_id", train_rows, "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                mine = counts.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
                for numbers in buckets(text):
                    mine += np.bincount(numbers, minlength=1 << BITS)
        for lang, mine in counts.items():
            some = np.flatnonzero(mine)
            yield pd.DataFrame({"lang": lang, "bucket": some, "n": mine[some]})

    spread = sample.select("lang", "text", "doc_id").repartition(TRAIN_PARTS, "doc_id")
    counted = spread.mapInPandas(count, "lang string, bucket int, n bigint")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["lang"]: r["n"] for r in counts.limit(MAX_LABELS + 1).collect()}
    languages = sorted(sizes)
    if len(languages) > MAX_LABELS:
        raise ValueError(f"over {MAX_LABELS} languages: lang does not look like a label")
    seen = np.ones((len(languages), 1 << BITS))
    row = table["lang"].map({v: i for i, v in enumerate(languages)}).to_numpy(dtype=np.int64)
    np.add.at(seen, (row, table["bucket"].to_numpy(dtype=np.int64)), table["n"].to_numpy(dtype=np.float64))
    log = np.log(seen / seen.sum(axis=1, keepdims=True)).T if languages else np.zeros((1 << BITS, 0))
    prior = np.array([sizes[v] for v in languages], dtype=np.float64)
    return Model(languages, np.log(prior / prior.sum()) if languages else prior, np.ascontiguousarray(log))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row: the most probable language and its posterior
    probability; ``und`` and 0 for a text that is null or has no letter, or if nothing was learnt.
    Equal probabilities fall to the language first in the alphabet."""
    # Buckets times languages, both bounded.
    shared = docs.sparkSession.sparkContext.broadcast(plain(model))

    def score(batch: pa.RecordBatch) -> list:
        known = Model(*shared.value)
        found = [guess(text, known) for text in batch.column("text").to_pylist()]
        return [[f[0] for f in found], [f[1] for f in found]]

    return map_batches(docs.select("doc_id", "text"), ["doc_id"], "lang_pred string, score double", score)


def guess(text: str | None, model: Model) -> tuple[str, float]:
    if text is None or not model.languages or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    p = model.posterior(text)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row, by a model learnt from the rows that are
    not held out."""
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with a probability of ``least_score``, in their
    columns. The rest, texts without a letter above all, goes."""
    shared = docs.sparkSession.sparkContext.broadcast(plain(fit(docs)))  # of bounded size, as above

    def found(texts: list[str | None]) -> list[bool]:
        known = Model(*shared.value)
        guesses = [guess(text, known) for text in texts]
        return [lang != UNKNOWN and score >= least_score for lang, score in guesses]

    return keep_rows(docs, "text", found)
