"""op12: packing by patterns."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from stepwise.llm import pattern_packing as pp
from stepwise.llm.queries import QUERIES, tokenizer_path


def filled(plan):
    """Tokens in each sequence, and that the runs of a length follow on one another."""
    fill, taken = np.zeros(plan.sequences, np.int64), {}
    for length, first, n, each, sequence, offset in plan.runs:
        assert taken.get(length, 0) == first
        taken[length] = first + n * each
        assert (fill[sequence : sequence + n] == offset).all()
        fill[sequence : sequence + n] += length * each
    return fill, taken


def best_fit_only(histogram, size):
    plan = pp.Plan(size)
    plan.best_fit(histogram.copy(), [])
    return plan


def best_fit_plain(lengths, size):
    gaps = []
    for length in sorted(lengths, reverse=True):
        at = min((k for k in range(len(gaps)) if gaps[k] >= length), key=lambda k: gaps[k], default=None)
        if at is None:
            gaps.append(size - length)
        else:
            gaps[at] -= length
    return len(gaps)


CASES = {
    "few": [5, 6, 7],
    "none": [],
    "whole": [64] * 5,
    "halves": [32] * 7,
    "hot": [22] * 400 + list(range(1, 65)) * 3,
    "long": list(range(30, 60)) * 9,
    "mixed": np.random.default_rng(2).integers(1, 65, 3000).tolist(),
    "short": np.random.default_rng(3).integers(1, 9, 500).tolist(),
}


@pytest.mark.parametrize("case", CASES)
def test_every_piece_has_a_place_and_few_sequences_are_used(case):
    histogram = np.bincount(CASES[case], minlength=65).astype(np.int64)
    plan = pp.plan(histogram, 64, slack=1)
    fill, taken = filled(plan)
    assert taken == {k: n for k, n in enumerate(histogram.tolist()) if n}
    assert (fill <= 64).all() and (fill > 0).all()
    plain = best_fit_plain(CASES[case], 64)
    assert plan.sequences <= 1.02 * plain + 1
    alone = best_fit_only(histogram, 64)
    filled(alone)
    assert alone.sequences == plain


def test_patterns_fill_what_best_fit_cannot():
    lengths = [40, 35, 29, 24] * 100 + [26, 38] * 100  # exact pairs and triples
    plan = pp.plan(np.bincount(lengths, minlength=65).astype(np.int64), 64, slack=0)
    filled(plan)
    assert plan.sequences == sum(lengths) // 64


def test_fit_is_a_least_squares_fit():
    histogram = np.zeros(11, np.int64)
    histogram[[2, 3, 5, 8]] = [10, 4, 7, 10]
    found = pp.patterns(histogram, 0, 1000)
    assert {tuple(sorted(x for x in p if x)) for p in found.parts.tolist()} == {(2, 8), (5, 5), (2, 3, 5)}
    x = pp.fit(found, histogram.astype(float), 2000)
    matrix = np.zeros((11, len(found.parts)))
    for k, parts in enumerate(found.parts.tolist()):
        for v in parts:
            matrix[v, k] += v > 0
    slope = matrix.T @ (matrix @ x - histogram)
    assert (x >= 0).all() and (np.abs(slope[x > 1e-6]) < 1e-4).all() and (slope > -1e-4).all()


def test_thinned_patterns_are_the_frequent_ones():
    histogram = np.ones(65, np.int64)
    histogram[0], histogram[22] = 0, 10_000
    found = pp.patterns(histogram, 2, 10)
    assert len(found.parts) == 10 and (found.parts == 22).any(1).all()


def checked(spark, docs, rows, size):
    """The contract of op12 for rows of (doc_id, text)."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = pp.pack_by_patterns(docs, tokenizer_path(), size=size, with_ids=True).collect()
    want = sorted((repr(i), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows)
    texts, at = [], None
    pieces = sorted(got, key=lambda r: (repr(r.doc_id), r.piece))
    by_doc = {}
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(ids) == r.length and r.start == r.piece * size
        by_doc.setdefault(repr(r.doc_id), []).append((r.piece, ids))
    distinct = len({repr(i) for i, _ in rows}) == len(rows)
    if distinct:
        texts = [(i, [x for _, ids in sorted(p) for x in ids]) for i, p in sorted(by_doc.items())]
        assert texts == want
        assert all(len(p) == -(-len(w) // size) for (_, w), p in zip(want, (by_doc[i] for i, _ in want), strict=True))
    assert sum(r.length for r in got) == sum(len(w) for _, w in want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return sequences, got


def test_pieces_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (None, "two words"), (5, "word " * 30_000), (6, "x" * 20_000), (7, "same text"), (8, "same text"), (9, "ünïcode 你好\x00")]
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, part string, length int").repartition(3)
    checked(spark, docs, rows, 4096)
    checked(spark, docs, rows, 64)
    twice = [(1, "a b"), (1, "a b"), (1, "c"), (None, "d"), (None, "d")]
    _, got = checked(spark, spark.createDataFrame(twice, "doc_id long, text string"), twice, 64)
    assert len(got) == 5
    assert pp.pack_by_patterns(docs.limit(0), tokenizer_path()).count() == 0


def test_a_hot_length_is_dealt_over_partitions(spark):
    rows = [(k, "same words here" if k % 3 else f"number {k} " * (k % 50)) for k in range(3000)]
    sequences, got = checked(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(8), rows, 128)
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 128) * 1.02 + 1


def test_query_on_the_tables(spark, sf):
    got = QUERIES["op12_pattern_packing"](spark, sf).collect()
    total, n = sum(r.length for r in got), len({r.sequence_id for r in got})
    assert total <= 4096 * n <= 1.02 * total + 4096
