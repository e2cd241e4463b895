"""Tokens are parted in one pass; stems and frequencies come to the postings while they are few."""

from __future__ import annotations

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from webloom.functions import text as text_fn
from webloom.functions.fixed_values import TOKEN_PUNCTUATION
from webloom.functions.stem import stem
from webloom.operators import index
from webloom.plans import QUERIES


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as said:
        df.explain()
    return said.getvalue()


def test_tokens_part_texts_in_one_pass(spark):
    rng = random.Random(6)
    signs = [" ", " ", "\n", "\t", "\r", "\x85", " ", "\x1c", "\xa0", "\x0b", "a", "B", "-", "."]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(14))) for _ in range(4000)]
    table = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    space = f"{text_fn.SPACE}* {text_fn.SPACE}*"
    stepwise = F.regexp_replace(text_fn.clean_text(F.col("text")), space, " ")
    stepwise = F.array_remove(F.split(F.translate(F.lower(stepwise), TOKEN_PUNCTUATION, ""), " "), "")
    made = table.select(text_fn.tokens(F.col("text")).alias("made"), stepwise.alias("want"))
    assert made.where("made is not null and size(made) > 1").count() > 300
    assert made.where("not made <=> want").count() == 0
    assert plan(made.select("made")).count("regexp_replace") == 1


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_terms_come_to_the_postings(spark, monkeypatch, most):
    monkeypatch.setattr(index, "LISTED_BYTES", most, raising=False)
    held = [(t, d) for d in (*range(30), None) for t in ("turn", "turning", f"words{d}")]
    plain = spark.createDataFrame(held, "term string, doc_id bigint")
    skewed = []
    monkeypatch.setattr(index, "join_skewed", lambda *a, f=index.join_skewed, **b: skewed.append(a) or f(*a, **b))
    made = [tuple(r) for r in index.stem_postings(plain, min_rows=5).select("term", "doc_id").collect()]
    assert len(made) == len(set(made)) and set(made) == {(stem(t), d) for t, d in held}
    assert bool(skewed) == (most == 0)


ODD = [(1, "turn tide turn"), (2, "tide"), (2, "tide harbour"), (2, "tide"), (None, "lost tide"), (None, "lost"), (3, None), (4, ""), (5, "the, and")]


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_document_postings_of_odd_rows(spark, monkeypatch, most):
    monkeypatch.setattr(index, "REPEATED_IDS", most)
    for odd in (ODD, ODD[:2], []):
        docs = spark.createDataFrame(odd, "doc_id bigint, text string")
        made = [tuple(r) for r in index.document_postings(docs).collect()]
        want = [tuple(r) for r in index.postings(index.normalize(docs)).collect()]
        assert len(made) == len(set(made)) and set(made) == set(want)


def test_ids_that_come_once_are_not_shuffled(spark, tmp_path):
    spark.createDataFrame([(n, f"tide tide w{n}") for n in range(30)], "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    made = QUERIES["doc_frequency"].build(spark, str(tmp_path))
    assert dict(tuple(r) for r in made.collect()) == {"tide": 30} | {f"w{n}": 1 for n in range(30)}
    final = plan(made).partition("Initial Plan")[0]
    assert "Final Plan" in final and not re.search(r"hashpartitioning\(term#\d+, doc_id", final)
