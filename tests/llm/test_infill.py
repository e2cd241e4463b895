"""Fill-in-middle: cuts by the block tree against plain scanning, outputs against a direct rewrite."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.llm import infill

LINE = re.compile(r"[^\n]*\n|[^\n]+")


@pytest.mark.parametrize("block", [4, 7, 1024])
def test_cuts_equal_scanning(block):
    rng = np.random.default_rng(block)
    for _ in range(100):
        texts = ["".join(rng.choice(list("ab\né漢😀\r"), size=rng.integers(0, 40))) for _ in range(rng.integers(0, 6))]
        raw = [t.encode() for t in texts]
        ends = np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)])
        draws = rng.integers(0, 2**32, size=(len(texts), 2))
        units, cuts, points = infill.cut_points(np.frombuffer(b"".join(raw), np.uint8), ends, draws, block)
        for i, text in enumerate(texts):
            lines = LINE.findall(text)
            a, b = sorted(int(d) % (len(lines) + 1) for d in draws[i])
            before = ["".join(lines[:n]) for n in (a, b)]
            assert units[i] == len(lines)
            assert points[i].tolist() == [len(x) for x in before]
            assert (cuts[i] - ends[i]).tolist() == [len(x.encode()) for x in before]


def direct(doc_id, text):
    """The contract, text by text."""
    text = text or ""
    lines = LINE.findall(text)
    n = len(lines)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_outputs_and_edge_cases(spark):
    texts = [None, "", "\n", "\n\n", "no end", "a\nb\n", "a\r\nb", "a<\nS>b\n<", "has <M> in it", "é\n漢\n😀"] * 6
    texts += ["line %d\n" % i * 3 for i in range(40)] + ["x" * 300_000 + "\n" + "long 漢\n" * 100_000]
    data = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "same id\nother text\n", "c", 2), (None, "a\nb\nc", "c", 3)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, form string, n int")
    made = infill.rearranged(docs)
    found = sorted(made.collect(), key=str)
    assert sorted((tuple(r) for r in found), key=str) == sorted(
        ((d[0], *direct(d[0], d[1])) for d in data), key=str
    )
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    whole = made.select("doc_id", infill.restored(F.col("form"), F.col("output")).alias("text"))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(((d[0], d[1] or "") for d in data), key=str)
    assert infill.rearranged(docs.limit(0)).count() == 0
    assert infill.rearranged(docs, rate=0).where("form <> 'plain'").count() == 0
