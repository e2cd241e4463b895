"""Alignment of two tokenizers against a direct walk over their tokens."""

import hashlib
import os
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from webloom.llm import alignment, vocab

A_PATH, B_PATH = vocab.public_path(vocab.BYTE_BPE), vocab.public_path(vocab.PIECE_BPE)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]


@pytest.fixture(scope="module")
def walk():
    a_lib = Tokenizer.from_file(A_PATH)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = vocab.byte_of_letter()

    def b_bytes(i):
        piece = b_lib.id_to_piece(i)
        coded = re.fullmatch("<0x(..)>", piece)
        return bytes([int(coded[1], 16)]) if coded else piece.replace("▁", " ").encode()

    def spans(made):
        ends = np.cumsum([len(x) for x in made]).tolist()
        return list(zip([0, *ends[:-1]], ends))

    def one(text):
        """(A ids, B ids, groups, links as id pairs, overlaps) or None."""
        if not text:
            return None
        a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        raw_a, raw_b = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return None
        at_a, at_b = spans(raw_a), spans(raw_b)
        groups, links, overlaps, start = [], [], 0, 0
        for end in sorted({e for _, e in at_a} & {e for _, e in at_b}):
            in_a = [i for i, (s, e) in enumerate(at_a) if start <= s and e <= end]
            in_b = [i for i, (s, e) in enumerate(at_b) if start <= s and e <= end]
            groups.append("|".join(",".join(map(str, x)) for x in ([a[i] for i in in_a], [b[i] for i in in_b])))
            links += [(a[i], b[j]) for i in in_a for j in in_b]
            overlaps += sum(max(at_a[i][0], at_b[j][0]) < min(at_a[i][1], at_b[j][1]) for i in in_a for j in in_b)
            start = end
        return a, b, groups, links, overlaps

    return one


def expected(walk, data):
    found = [(doc_id, walk(text)) for doc_id, text in data]
    counts = Counter(pair for _, w in found if w for pair in set(w[3]))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for doc_id, w in found:
        if w is None:
            rows.append((doc_id, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        a, b, groups, links, overlaps = w
        n_best = sum(counts[p] == best[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((doc_id, len(a), len(b), len(groups), len(links), n_best, sum(counts[p] for p in links), digest, overlaps))
    return sorted(rows, key=str)


def as_tuples(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "<|endoftext|>", "<s>", "漢", "é", "\x1f", "▁", "1", "23", ".", "　", "\x00", "😀", "fox", "ﬁ", "<0x41>", "\r"]
    return ["".join(rng.choice(alphabet, size=rng.integers(0, 18))) for _ in range(400)]


def test_table_equals_walk(spark, walk, texts, sf_dir):
    data = [(i, t) for i, t in enumerate([None, "", "▁", " ", *texts])]
    data += [(5, "same id"), (5, "same id"), (None, "no id here"), (9_000, "the fox " * 4_000)]
    docs = spark.createDataFrame([(*d, 1, "x") for d in data], "doc_id bigint, text string, pairs int, n_a string")
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 3000").select("doc_id", "text")
    data += [tuple(r) for r in given.collect()]
    docs = docs.select("doc_id", "text", "pairs", "n_a").unionByName(given, allowMissingColumns=True)
    want = expected(walk, data)
    assert as_tuples(alignment.alignment_table(docs)) == want
    assert as_tuples(alignment.alignment_table(docs, broadcast_pairs=0)) == want
    assert alignment.alignment_table(docs.limit(0)).count() == 0


def test_products_equal_dense_ones():
    rng = np.random.default_rng(4)
    for _ in range(40):
        a, b = rng.random((5, 7)) < 0.4, rng.random((6, 7)) < 0.4
        sparse = [alignment.Sparse.of(m.sum(axis=1), np.nonzero(m)[1], 7) for m in (a, b)]
        made = alignment.product(sparse[0], sparse[1].transposed())
        dense = np.zeros((5, 6), dtype=int)
        dense[made.rows(), made.columns] = made.values
        assert (dense == a.astype(int) @ b.T.astype(int)).all() and (made.values > 0).all()


def test_overlaps_are_links():
    ends_a, ends_b = np.array([2, 5, 6, 9]), np.array([1, 5, 7, 9])
    overlaps, shared, group_a, group_b = alignment.linked(ends_a, ends_b)
    cells = [set(zip(m.rows().tolist(), m.columns.tolist())) for m in (overlaps, shared)]
    assert cells[0] < cells[1]
    assert group_a.tolist() == [0, 0, 1, 1] and group_b.tolist() == [0, 0, 1, 1]
    assert overlaps.values.sum() == 9


def test_vocabularies_are_not_copied():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    names = {f for _, _, files in os.walk(root) for f in files}
    assert not names & {vocab.BYTE_BPE, vocab.PIECE_BPE}
