"""Profiles and their ranking: ratings are evaluated once, blocks are written once."""

from __future__ import annotations

import contextlib
import io
import random

import pandas as pd
import pyarrow as pa
import pytest

from webloom.operators import profiles as pf


def counted(spark, df):
    """``df`` and an accumulator of the rows that are drawn from it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def tables(spark):
    ratings = [(u, i, float(1 + (u * i) % 5)) for u in range(6) for i in range(12) if (u + i) % 3]
    profiles = [(i, f"f{f}", 0.1 + (i * f) % 7) for i in range(11) for f in range(4)]
    return (
        spark.createDataFrame([*ratings, (None, 1, 2.0)], "user bigint, item bigint, rating double"),
        spark.createDataFrame(profiles, "item bigint, feature string, weight double"),
        ratings,
        profiles,
    )


@pytest.mark.parametrize("min_rows", [1, 5, 1000])
def test_ratings_are_evaluated_once_for_user_profiles(spark, tables, min_rows):
    rated, seen = counted(spark, tables[0])
    found = {(r.user, r.feature): r.weight for r in pf.user_profiles(rated, tables[1], min_rows).collect()}
    want, total = {}, {}
    known = {i for i, _, _ in tables[3]}
    for user, item, rating in tables[2]:
        if item in known:
            total[user] = total.get(user, 0) + rating
        for i, feature, weight in tables[3]:
            if i == item:
                want[user, feature] = want.get((user, feature), 0) + weight * rating
    assert found == pytest.approx({(u, f): w / total[u] for (u, f), w in want.items()})
    assert seen.value <= len(tables[2]) + 1


def test_blocks_meet_without_a_shuffle_of_copies(spark, tables):
    users = pf.user_profiles(tables[0], tables[1])
    one = pf.top_items(users, tables[1], k=2)
    many = pf.top_items(users, tables[1], k=2, user_block=2, item_block=3)
    rows = [sorted((r.user, r["rank"], r.item, round(r.score, 9)) for r in t.collect()) for t in (one, many)]
    assert rows[0] == rows[1] and len(rows[0]) == 12
    assert "CartesianProduct" in plan_of(many) and "CoGroups" not in plan_of(many)


def unit_rows(vectors):
    """Rows ``(id, label, value)`` of unit vectors given as ``{id: {label: value}}``."""
    lengths = {n: sum(w * w for w in v.values()) ** 0.5 for n, v in vectors.items()}
    return pd.DataFrame(
        [(n, f, w / lengths[n]) for n, v in vectors.items() for f, w in v.items()], columns=["id", "label", "value"]
    )


def test_few_items_of_one_kind_are_scored():
    generator = random.Random(7)
    items = {n: {"kind": 1.0, "price": generator.random()} for n in range(2000)}
    equal = {n: {"kind": 1.0, "other": 1.0} for n in range(2000, 4000)}
    users = {n: {"kind": 1.0, "price": 0.1 * n, "other": 0.01} for n in range(20)}
    found, scored = pf.best_in_block(unit_rows(users), unit_rows(items | equal), 2)
    assert len(found) == 40 and scored < 20 * 500
    for n, v in users.items():
        near = sorted(items, key=lambda m: abs(items[m]["price"] - v["price"]))[:10]
        assert set(found["item"][found["user"] == n]) <= set(near)
    one, scored = pf.best_in_block(unit_rows({0: {"kind": 1.0, "other": 1.0}}), unit_rows(items | equal), 3)
    assert one["item"].tolist() == [2000, 2001, 2002] and scored < 500


def test_threshold_of_all_items_holds_in_every_block():
    generator = random.Random(8)
    items = unit_rows({n: {f"f{n % 50}": 1.0, f"g{n % 7}": generator.random()} for n in range(3000)})
    users = unit_rows({n: {f"f{n}": 1.0, f"f{n + 1}": 0.5, "g0": 0.2} for n in range(40)})
    blocks = [
        pf._block(pa.array(t["id"]), pa.array(t["label"]), t["value"].to_numpy())
        for t in (users, items, items[items["id"] % 2 == 0], items[items["id"] % 2 == 1])
    ]
    least = pf._thresholds(blocks[0], blocks[1], 2)
    parts = [pf._best_of(blocks[0], least, pf.GroupedItems.of(b, 2), 2) for b in blocks[2:]]
    whole, _ = pf.best_in_block(users, items, 2)
    assert sum(p[3] for p in parts) < 40 * 100
    assert sum(len(p[2]) for p in parts) >= 80
    best = {}
    for p, b in zip(parts, blocks[2:]):
        for user, item, score in zip(p[0].tolist(), b.ids.take(pa.array(p[1])).to_pylist(), p[2].tolist()):
            best.setdefault(user, []).append((-score, item))
    found = {(u, i) for u, rows in best.items() for _, i in sorted(rows)[:2]}
    assert found == set(zip(whole["user"], whole["item"]))


@pytest.mark.parametrize("blocks", [(100, 100), (100, 4), (2, 100), (2, 4)])
def test_ranking_with_equal_doubled_and_missing_items(spark, blocks):
    generator = random.Random(9)
    rows = [(i % 9, f"f{f}", float((i % 9) * f % 4)) for i in range(9) for f in range(1, 4)]
    rows = [(i + 10 * c, f, w) for i, f, w in rows for c in range(2) if w] + [(3, "f1", 2.0), (3, "f1", 2.0)]
    users = [(u, f"f{f}", generator.random()) for u in range(5) for f in range(1, 5)]
    best = pf.top_items(
        spark.createDataFrame(users, "user bigint, feature string, weight double"),
        spark.createDataFrame(rows, "item bigint, feature string, weight double"),
        3, *blocks,
    )
    found = {(r.user, r["rank"]): (r.item, round(r.score, 9)) for r in best.collect()}
    for user in range(5):
        mine = {f: w for u, f, w in users if u == user}
        length = sum(w * w for w in mine.values()) ** 0.5
        scores = {}
        for item in {i for i, _, _ in rows}:
            own = [(f, w) for i, f, w in rows if i == item]
            norm = sum(w * w for _, w in own) ** 0.5
            scores[item] = round(sum(mine[f] * w for f, w in dict(sorted(own)).items()) / norm / length, 12)
        order = sorted(scores, key=lambda i: (-scores[i], i))[:3]
        assert [found[user, n + 1] for n in range(3)] == [(i, round(scores[i], 9)) for i in order]
    assert ("CartesianProduct" in plan_of(best)) == (blocks == (2, 4))
