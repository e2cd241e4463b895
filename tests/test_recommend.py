import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from webloom.operators import factorize as fz
from webloom.operators import profiles as pf
from webloom.plans import bindings

ITEMS = [
    ("i1", ["Tools", "red"], ["Big red tool", "a fine price"], "$10.00"),
    ("i2", ["Tools"], ["red red box"], "20"),
    ("i3", ["Games", "Games"], None, "$1,000"),
    ("i4", [], ["Über_tool x 9"], "$15"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item string, category array<string>, description array<string>, price string")


def python_tfidf(texts):
    counts = {i: Counter(re.findall(r"(?u)\b\w\w+\b", t.lower())) for i, t in texts.items()}
    df = Counter(w for c in counts.values() for w in c)
    out = {}
    for i, c in counts.items():
        raw = {w: n * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in c.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, w): v / length for w, v in raw.items()})
    return out


@pytest.mark.parametrize("min_rows", [1, 1000])
def test_tfidf(items, min_rows):
    texts = {i: " ".join(d or []) for i, _, d, _ in ITEMS}
    found = {(r.item, r.feature): r.weight for r in pf.tfidf(pf.description_text(items), min_rows).collect()}
    assert found == pytest.approx(python_tfidf(texts))


def test_price_scaling(spark, items):
    assert dict(rows(pf.price_features(items), "item", "weight")) == {"i1": 0.0, "i2": 1.0, "i4": 0.5}
    one = items.where("item = 'i1'")
    assert rows(pf.price_features(one), "item", "weight") == [("i1", 0.0)]


def test_profile_families(items):
    profiles = pf.item_profiles(items)
    found = {(r.item, r.family, r.feature) for r in profiles.collect()}
    assert ("i1", "category", "red") in found and ("i3", "category", "Games") in found
    # "red" is a category and "price" the price column, so the terms of that name give way.
    assert not {f for f in found if f[1] == "term" and f[2] in ("red", "price")}
    assert ("i1", "term", "fine") in found and ("i1", "price", "price") in found
    assert len(profiles.collect()) == len(found)
    kept = {(r.item, r.feature): r.weight for r in profiles.where("family = 'term'").collect()}
    whole = python_tfidf({i: " ".join(d or []) for i, _, d, _ in ITEMS})
    assert kept == pytest.approx({k: w for k, w in whole.items() if k[1] not in ("red", "price")})


def test_repeated_columns(spark):
    table = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x", "y", "x")
    kept = pf.drop_repeated_columns(table)
    assert kept.columns == ["x", "y"] and tuple(kept.first()) == (1, 2)


def test_rating_rows(spark):
    table = spark.createDataFrame(
        [("u", "a", 5.0), ("u", None, 1.0), ("v", "a", float("nan")), ("u", "a", 4.0)],
        "user string, item string, rating double",
    )
    clean = pf.clean_ratings(table)
    assert rows(clean) == [("u", "a", 4.0), ("u", "a", 5.0)]
    assert rows(pf.mean_rating(clean)) == [("u", "a", 4.5)]
    assert rows(pf.first_rows(clean, 1, ["rating"])) == [("u", "a", 4.0)]


@pytest.mark.parametrize("min_rows", [1, 1000])
@pytest.mark.parametrize("blocks", [(1000, 1000), (3, 2)])
def test_profiles_and_ranking_against_numpy(spark, min_rows, blocks):
    generator = random.Random(5)
    features = {
        (f"i{n}", f"f{generator.randint(0, 9)}"): generator.random() for n in range(15) for _ in range(4)
    }
    ratings = {(f"u{generator.randint(0, 7)}", f"i{generator.randint(0, 16)}"): generator.randint(1, 5) for _ in range(50)}
    profiles = spark.createDataFrame([(i, f, w) for (i, f), w in features.items()], "item string, feature string, weight double")
    rated = spark.createDataFrame([(u, i, float(r)) for (u, i), r in ratings.items()], "user string, item string, rating double")
    names, columns = sorted({i for i, _ in features}), sorted({f for _, f in features})
    matrix = np.zeros((len(names), len(columns)))
    for (i, f), w in features.items():
        matrix[names.index(i), columns.index(f)] = w
    expected = {}
    for user in {u for u, _ in ratings}:
        own = [(names.index(i), r) for (u, i), r in ratings.items() if u == user and i in names]
        if own:
            expected[user] = sum(matrix[n] * r for n, r in own) / sum(r for _, r in own)
    users = pf.user_profiles(rated, profiles, min_rows)
    found = {(r.user, r.feature): r.weight for r in users.collect()}
    assert found == pytest.approx(
        {(u, columns[n]): v[n] for u, v in expected.items() for n in range(len(columns)) if v[n]}
    )
    best = pf.top_items(users, profiles, k=3, user_block=blocks[0], item_block=blocks[1])
    ranked = {(r.user, r["rank"]): (r.item, r.score) for r in best.collect()}
    assert len(ranked) == 3 * len(expected)
    for user, vector in expected.items():
        scores = matrix @ vector / np.linalg.norm(matrix, axis=1) / np.linalg.norm(vector)
        order = sorted(range(len(names)), key=lambda n: (-round(scores[n], 12), names[n]))[:3]
        assert [ranked[(user, n + 1)][0] for n in range(3)] == [names[n] for n in order]
        assert [ranked[(user, n + 1)][1] for n in range(3)] == pytest.approx([scores[n] for n in order])


def unit_frame(vectors):
    vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    row, column = np.nonzero(vectors)
    labels = np.array([f"f{c:03d}" for c in column], dtype=object)
    return pd.DataFrame({"id": row, "label": labels, "value": vectors[row, column]}), vectors


@pytest.mark.parametrize("negative", [False, True])
@pytest.mark.parametrize("k", [1, 3, 50])
def test_bounded_scoring_equals_all_pairs(negative, k):
    rng = np.random.default_rng(k)
    kinds = rng.random((40, 60)) * (rng.random((40, 60)) < 0.1) + 0.01 * np.eye(40, 60)
    # Items of a kind differ in one weight; many are alike.
    items = kinds[rng.integers(0, 40, 2000)] * 10
    items[:, 59] = rng.integers(0, 3, 2000) * 0.1
    users = kinds[rng.integers(0, 40, (60, 3))].mean(axis=1) + 1e-3
    users -= 0.2 * rng.random((60, 60)) * negative
    a, u = unit_frame(users)
    b, i = unit_frame(items)
    found, scored = pf.best_in_block(a, b, k)
    scores = (u @ i.T).round(12)
    for n in range(60):
        order = sorted(range(2000), key=lambda m: (-scores[n, m], m))[:k]
        mine = found[found["user"] == n]
        assert mine["score"].to_numpy() == pytest.approx(scores[n, order], abs=1e-11)
        assert len(set(mine["item"])) == k
        assert set(mine["item"][mine["score"] > scores[n, order[-1]] + 1e-11]) <= set(order)
    assert k == 50 or scored < 0.25 * scores.size


def test_given_items_are_seldom_scored(spark, sf_dir):
    items = pf.item_profiles(bindings.items(spark, sf_dir))
    users = pf.user_profiles(bindings.ratings(spark, sf_dir), items)
    frames = [
        pf._unit_vectors(t.select(key, "feature", "weight").toDF("id", "label", "value")).toPandas()
        for t, key in ((users, "user"), (items, "item"))
    ]
    found, scored = pf.best_in_block(*frames, 2)
    pairs = frames[0]["id"].nunique() * frames[1]["id"].nunique()
    assert len(found) == 2 * frames[0]["id"].nunique() and scored < pairs


# --- factorisation ---------------------------------------------------------------------------

RATINGS = [(0, 0, 5.0), (0, 1, 4.0), (1, 1, 5.0), (1, 2, 3.0), (2, 0, 4.0), (2, 3, 1.0)]


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id bigint, item_id bigint, rating double")


def numpy_start(ids, k, scale):
    return np.array([[(i * 31 + (n + 1) * 17) % 97 / 97 * scale for n in range(k)] for i in range(ids)])


def as_matrices(factors, k):
    table = {(r["side"], r["id"]): [r[f"f{n}"] for n in range(k)] for r in factors.collect()}
    users = np.array([table[("u", i)] for i in range(3)])
    return users, np.array([table[("i", j)] for j in range(4)])


def numpy_batch(iterations, k=2, rate=0.01, decay=0.01, scale=0.1):
    a, b = numpy_start(3, k, scale), numpy_start(4, k, scale)
    rated, mask = np.zeros((3, 4)), np.zeros((3, 4))
    for u, i, r in RATINGS:
        rated[u, i], mask[u, i] = r, 1
    for _ in range(iterations):
        error = (rated - a @ b.T) * mask
        step_a, step_b = -2 * error @ b + decay * a, -2 * error.T @ a + decay * b
        a, b = a - rate * step_a, b - rate * step_b
    return a, b


@pytest.mark.parametrize("min_rows", [1, 1000])
def test_batch_descent_against_numpy(ratings, min_rows):
    seen = []
    factors = fz.descend(ratings, iterations=4, report=lambda n, f: seen.append(n), report_every=2, min_rows=min_rows)
    a, b = numpy_batch(4)
    found_a, found_b = as_matrices(factors, 2)
    assert np.allclose(found_a, a) and np.allclose(found_b, b) and seen == [0, 2]
    error = fz.squared_error(fz.predict(ratings, factors)).first()["squared_error"]
    assert error == pytest.approx(sum((r - a[u] @ b[i]) ** 2 for u, i, r in RATINGS))


def test_ids_without_rating_only_decay(ratings):
    start = fz.start_factors(ratings, 2)
    rest = ratings.where("item_id <> 3")
    old = {(r["side"], r["id"]): r["f0"] for r in start.collect()}
    new = {(r["side"], r["id"]): r["f0"] for r in fz.gradient_step(rest, start, 0.5, 0.1).collect()}
    assert new[("i", 3)] == pytest.approx(old[("i", 3)] * (1 - 0.05)) and len(new) == len(old)


def test_clipping(ratings):
    start = fz.start_factors(ratings, 2, scale=0.1)
    old = as_matrices(start, 2)
    clipped = as_matrices(fz.gradient_step(ratings, start, 1.0, 0.0, clip_at=0.01), 2)
    counts = Counter(u for u, _, _ in RATINGS)
    assert np.all(np.abs(clipped[0] - old[0]) <= 0.01 * np.array([[counts[u]] for u in range(3)]) + 1e-12)


def numpy_sequential(epochs, k, rate, decay, scale, bound=np.inf):
    a, b = numpy_start(3, k, scale), numpy_start(4, k, scale)
    for _ in range(epochs):
        for u, i, r in sorted(RATINGS):
            error = r - a[u] @ b[i]
            step_a = np.clip(-2 * error * b[i] + decay * a[u], -bound, bound)
            step_b = np.clip(-2 * error * a[u] + decay * b[i], -bound, bound)
            a[u], b[i] = a[u] - rate * step_a, b[i] - rate * step_b
    return a, b


def test_one_block_is_the_sequential_algorithm(ratings):
    factors = fz.stochastic_descent(ratings, epochs=3, blocks=1)
    a, b = numpy_sequential(3, 2, 0.01, 0.01, 0.1)
    found = as_matrices(factors, 2)
    assert np.allclose(found[0], a) and np.allclose(found[1], b)
    clipped = fz.stochastic_descent(ratings, epochs=1, blocks=1, learning_rate=0.5, clip_at=0.05)
    a, _ = numpy_sequential(1, 2, 0.5, 0.01, 0.1, bound=0.05)
    assert np.allclose(as_matrices(clipped, 2)[0], a)


def test_strata_visit_every_rating(ratings):
    start = fz.start_factors(ratings, 2)
    before = fz.squared_error(fz.predict(ratings, start)).first()[0]
    seen = []
    factors = fz.stochastic_descent(
        ratings, epochs=2, blocks=3, learning_rate=0.05, report=lambda n, f: seen.append(n), report_every=1
    )
    moved = {(r["side"], r["id"]): r["f0"] for r in factors.collect()}
    old = {(r["side"], r["id"]): r["f0"] for r in start.collect()}
    assert set(moved) == set(old) and all(moved[key] != old[key] for key in old) and seen == [0, 1]
    assert fz.squared_error(fz.predict(ratings, factors)).first()[0] < before


def test_nan_starts_afresh(spark, ratings):
    bad = fz.start_factors(ratings, 2).withColumn("f0", F.when(F.col("id") == 1, float("nan")).otherwise(F.col("f0")))
    assert fz.any_nan(bad).first()[0] and not fz.any_nan(fz.start_factors(ratings, 2)).first()[0]
    # The second epoch starts from other values than the first one did.
    again = fz.stochastic_descent(ratings, epochs=2, blocks=1, factors=bad)
    once = fz.stochastic_descent(ratings, epochs=1, blocks=1, factors=fz.start_factors(ratings, 2, draw=1))
    assert rows(again) == rows(once) and rows(fz.start_factors(ratings, 2)) != rows(fz.start_factors(ratings, 2, draw=1))
    with pytest.raises(ArithmeticError):
        fz.stochastic_descent(ratings, epochs=3, blocks=1, learning_rate=1e200)


def test_split_and_metrics(spark):
    table = spark.range(4000).select((F.col("id") % 80).alias("user_id"), F.col("id").alias("item_id"), F.lit(3.0).alias("rating"))
    split = fz.train_test(table)
    share = split.where("split = 'train'").count() / 4000
    assert 0.77 < share < 0.83
    assert rows(split.repartition(9)) == rows(split.coalesce(1))
    assert fz.train_test(table, train_share=1.0).where("split = 'test'").count() == 0
    predicted = spark.createDataFrame(
        [("test", 1.0, 2.0), ("test", 3.0, 0.0), ("train", 1.0, 1.0)], "split string, rating double, prediction double"
    )
    found = {r["split"]: (r["n"], r["mae"], r["rmse"]) for r in fz.metrics(predicted).collect()}
    assert found == {"test": (2, 2.0, math.sqrt(5)), "train": (1, 0.0, 0.0)}


def test_index_and_last_rating(spark):
    table = spark.createDataFrame(
        [("b", "x", 1.0, 1), ("a", "y", 2.0, 2), ("b", "y", 3.0, 3), ("b", "x", 4.0, 4), ("c", "x", 5.0, 5)],
        "user string, item string, rating double, seq bigint",
    )
    users = fz.first_seen_ids(table, "user", "user_id", partitions=2)
    items = fz.first_seen_ids(table, "item", "item_id")
    assert rows(users) == [("a", 1), ("b", 0), ("c", 2)] and rows(items) == [("x", 0), ("y", 1)]
    assert rows(fz.last_rating(table)) == [("a", "y", 2.0), ("b", "x", 4.0), ("b", "y", 3.0), ("c", "x", 5.0)]
    for min_rows in (1, 1000):
        dense = fz.with_dense_ids(fz.last_rating(table), users, items, min_rows)
        assert rows(dense) == [(0, 0, 4.0), (0, 1, 3.0), (1, 1, 2.0), (2, 0, 5.0)]


def test_als(ratings):
    model = fz.fit_als(ratings, k=2, decay=0.05, iterations=15)
    found = model.transform(ratings.select(
        F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating"))
    assert found.count() == len(RATINGS)
    assert found.select(F.avg(F.abs(F.col("rating") - F.col("prediction")))).first()[0] < 0.5


def test_each_epoch_deals_new_batches(spark):
    pairs = spark.range(40).select(F.col("id").alias("user_id")).crossJoin(spark.range(50).select(F.col("id").alias("item_id")))
    dealt = pairs.select(*[fz.batch_number(epoch, 4).alias(f"e{epoch}") for epoch in range(3)]).toPandas()
    for epoch in range(3):
        assert (dealt[f"e{epoch}"].value_counts() / 2000).between(0.2, 0.3).all()
    # Two epochs agree on a quarter of the ratings, and no batch of one is a batch of the other.
    for a, b in ((0, 1), (1, 2), (0, 2)):
        table = pd.crosstab(dealt[f"e{a}"], dealt[f"e{b}"])
        assert table.shape == (4, 4) and table.min().min() > 60
