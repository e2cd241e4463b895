"""The stored index: blocks, their directory, and searches that read few of them."""

import contextlib
import io
import re

import numpy as np
import pytest

from tests.conftest import rows
from webloom.operators import index, stored_index


def built(spark, tmp_path, postings, block_ids):
    table = spark.createDataFrame(postings, "term string, doc_id bigint")
    stored_index.write_stored_index(table, str(tmp_path / "index"), block_ids=block_ids)
    return table, *stored_index.read_stored_index(spark, str(tmp_path / "index"))


def test_blocks_and_searches(spark, tmp_path):
    rng = np.random.default_rng(4)
    lists = {
        "often": rng.choice(20_000, 6_000, replace=False),
        "too": rng.choice(20_000, 5_000, replace=False),
        "seldom": rng.choice(20_000, 9, replace=False),
        "bunch": np.arange(500, 700),
        "one": np.array([19_999]),
    }
    postings = [(term, int(d)) for term, ids in lists.items() for d in ids]
    table, blocks, directory = built(spark, tmp_path, postings, 64)
    for term, ids in lists.items():
        stored = blocks.where(blocks.term == term).orderBy("block").collect()
        assert [d for r in stored for d in r["doc_ids"]] == sorted(ids.tolist())
        assert all(len(r["doc_ids"]) <= 64 for r in stored)
        listed = directory.where(directory.term == term).orderBy("block").collect()
        assert [(r["first_id"], r["last_id"], r["n"]) for r in listed] == [
            (r["doc_ids"][0], r["doc_ids"][-1], len(r["doc_ids"])) for r in stored
        ]
        assert {r["df"] for r in listed} == {len(ids)}
    queries = {
        1: ["often", "too"],
        2: ["seldom", "often", "too"],
        3: ["bunch", "often"],
        4: ["one", "often"],
        5: ["seldom"],
        6: ["often", "unknown"],
        7: ["unknown"],
    }
    terms = spark.createDataFrame([(q, t) for q, ts in queries.items() for t in ts], "query_id int, term string")
    hits = stored_index.search_stored(terms, blocks, directory)
    expected = []
    for q, ts in queries.items():
        if all(t in lists for t in ts):
            common = set.intersection(*(set(lists[t].tolist()) for t in ts))
            expected += [(q, d) for d in common]
    assert rows(hits, "query_id", "doc_id") == sorted(expected, key=str)
    assert rows(hits, "query_id", "doc_id") == rows(index.boolean_query(terms, table), "query_id", "doc_id")


def test_only_overlapping_blocks_are_read(spark, tmp_path):
    postings = [("common", d) for d in range(20_000)] + [("usual", d) for d in range(0, 20_000, 2)]
    postings += [("rare", d) for d in (3, 10_001, 10_002)]
    _, blocks, directory = built(spark, tmp_path, postings, 50)
    terms = spark.createDataFrame([(1, "rare"), (1, "common"), (1, "usual")], "query_id int, term string")
    hits, read = stored_index._searched(terms, blocks, directory, stored_index.BUCKETS)
    assert rows(hits, "doc_id") == [(10_002,)]
    assert blocks.count() == 601
    # One block of the rare term, and of the others those around its three ids.
    assert read.count() <= 1 + 2 * 3
    assert read.where("term = 'rare'").count() == 1


def test_empty_index_and_no_queries(spark, tmp_path):
    none, blocks, directory = built(spark, tmp_path, [], 8)
    asked = spark.createDataFrame([(1, "x")], "query_id int, term string")
    assert none.count() == 0 and stored_index.search_stored(asked, blocks, directory).count() == 0


@pytest.mark.parametrize("many", [0, 100_000])
def test_lists_not_ids_are_numbered_and_cut(spark, tmp_path, monkeypatch, many):
    monkeypatch.setattr(stored_index, "SPAN", 50)
    monkeypatch.setattr(stored_index, "MANY_PARTS", many)
    numbered_columns = []
    monkeypatch.setattr(
        stored_index, "numbered", lambda df, *a, f=stored_index.numbered, **b: numbered_columns.append(df.columns) or f(df, *a, **b)
    )
    rng = np.random.default_rng(8)
    lists = {
        "dense": list(range(-70, 300)),
        "far": sorted({int(d) for d in rng.integers(-(1 << 62), 1 << 62, 90)}),
        "one": [1 << 62],
        "null": [None, *range(100)],
    }
    _, blocks, directory = built(spark, tmp_path, [(t, d) for t, ids in lists.items() for d in ids], 32)
    assert numbered_columns == ([] if many else [["term", "part", "places"]])
    for term, ids in lists.items():
        stored = {r["block"]: r["doc_ids"] for r in blocks.where(blocks.term == term).collect()}
        # A null id takes the first place and is in no block.
        want = {n // 32: [d for d in ids[n : n + 32] if d is not None] for n in range(0, len(ids), 32)}
        assert stored == want
        held = [d for d in ids if d is not None]
        listed = {r["block"]: (r["first_id"], r["last_id"], r["n"], r["df"], r["blocks"], r["top_id"]) for r in directory.where(directory.term == term).collect()}
        assert listed == {b: (x[0], x[-1], len(x), len(held), len(want), held[-1]) for b, x in want.items()}


def test_searches_leave_the_blocks_where_they_are(spark, tmp_path):
    postings = [(f"w{n % 40}", n) for n in range(400)] + [("all", n) for n in range(400)]
    _, blocks, directory = built(spark, tmp_path, postings, 16)
    # No list is broadcast by its estimated size.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        listed = index.short_list(directory.where("term = 'w1'").select("bucket", "term").distinct())
        assert listed[1] and not index.short_list(listed[0], most=0)[1]
        terms = spark.createDataFrame([(1, "w1"), (1, "all"), (2, "w2")], "query_id int, term string")
        hits, _ = stored_index._searched(terms, blocks, directory, stored_index.BUCKETS)
        assert rows(hits) == sorted([(1, n) for n in range(1, 400, 40)] + [(2, n) for n in range(2, 400, 40)], key=str)
        with contextlib.redirect_stdout(io.StringIO()) as said:
            hits.explain()
        scan = re.search(r"BroadcastHashJoin \[[^\n]*LeftSemi[^\n]*\n[^\n]*(?:Filter|ColumnarToRow|FileScan)", said.getvalue())
        assert scan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
