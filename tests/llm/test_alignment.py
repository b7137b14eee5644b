"""op13: alignment of two tokenizers against plain loops over occurrences."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stepwise.llm import alignment as al
from stepwise.llm.packing import _byte_letters
from stepwise.llm.queries import QUERIES, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """text -> tokens of both sides as (id, from, to), none unless both give the bytes of space and text."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {c: x for x, c in _byte_letters().items()}

    def of(text):
        sides = []
        for ids, token in ((a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(letters[c] for c in a.id_to_token(i))), (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())):
            at, side, joined = 0, [], b""
            for i in ids:
                raw = token(i)
                side.append((i, at, at + len(raw)))
                at, joined = at + len(raw), joined + raw
            if not text or joined != f" {text}".encode():
                return [], []
            sides.append(side)
        return sides

    return of


def expected(rows, plain):
    docs, holds = [], Counter()
    for doc, text in rows:
        a, b = plain(text or "")
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, low, i, j = [], 0, 0, 0
        for end in ends:
            mine = ([], [])
            while i < len(a) and a[i][2] <= end:
                mine[0].append(a[i][0])
                i += 1
            while j < len(b) and b[j][2] <= end:
                mine[1].append(b[j][0])
                j += 1
            groups.append("|".join(",".join(map(str, x)) for x in mine))
            low = end
        links, k = [], 0
        for x, start, to in a:
            while b[k][2] <= start:
                k += 1
            m = k
            while m < len(b) and b[m][1] < to:
                links.append((x, b[m][0]))
                m += 1
        holds.update(set(links))
        docs.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "", low))
    best = {}
    for (x, _), n in holds.items():
        best[x] = max(best.get(x, 0), n)
    return sorted([(*d[:4], len(d[4]), sum(holds[p] == best[p[0]] for p in d[4]), sum(holds[p] for p in d[4]), d[5]) for d in docs], key=repr)


def found(frame, **more):
    return sorted(map(tuple, al.align_tokens(frame, A, B, **more).select(*COLUMNS).collect()), key=repr)


ODD = [
    (1, "a  b\n\n c"), (None, None), (2, ""), (3, "x ▁ y"), (4, "<|endoftext|> <s> </s> <unk> ünïcödé 你好 \t tab"), (5, "don't  \n stop"), (6, " lead"), (7, "\x00 nul"),
    (8, "ﬁ ligature ½ é"), (None, "no id"), (9, "same words"), (9, "same words"), (10, "same words"), (11, "word " * 20_000), (12, "🙂🙂 ​　x"), (13, "   "), (14, "\n"), (15, "z" * 3000),
]


def test_odd_texts(spark, plain):
    frame = spark.createDataFrame([(*r, "b", 5) for r in ODD], "doc_id long, text string, block string, n int").repartition(3)
    assert found(frame) == expected(ODD, plain)
    assert found(frame.limit(0)) == []


def test_small_blocks_and_chunks(spark, plain, monkeypatch):
    rows = [(k, f"Text number {k} of the töwn, {'same ' * (k % 5)}end.") for k in range(200)] + ODD
    both = al.Tokenizers(A, B)
    block, out = al.Block(both.of_a, both.of_b), []
    for low in range(0, len(rows), 7):
        a, b = both.texts([(t or "").encode() for _, t in rows[low : low + 7]])
        used, first = block.chunk(a, b)
        block.count(used, first)
        out += [";".join(block.groups[w] for w in used[x:y]) for x, y in zip(first[:-1], first[1:], strict=True)]
    want = {(d, t): h for (d, t), h in zip(rows, [r[-1] for r in (expected([x], plain)[0] for x in rows)], strict=True)}
    assert [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in out] == [want[r] for r in rows]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(40)) == expected(rows, plain)


def test_windows_that_share_a_hash_are_told_apart(spark, plain, monkeypatch):
    monkeypatch.setattr(al, "_range_hash", lambda ids, cut, seed: np.zeros(len(cut) - 1, np.uint64))
    both = al.Tokenizers(A, B)
    block = al.Block(both.of_a, both.of_b)
    a, b = both.texts([b"one two three two one", b"two"])
    used, first = block.chunk(a, b)
    assert used[0] == used[4] and used[1] == used[3] == used[5] and len(set(used.tolist())) == 3 and first.tolist() == [0, 5, 6]


def test_other_route_of_the_byte_tokenizer_is_equal():
    both = al.Tokenizers(A, B)
    texts = [(t or "").encode() for _, t in ODD]
    quick = both.texts(texts)
    assert both.ranked is not None
    both.ranked = None
    assert all((x.ids == y.ids).all() and (x.first == y.first).all() for x, y in zip(quick, both.texts(texts), strict=True))


def test_groups_are_given_on_request(spark):
    frame = spark.createDataFrame([(1, "unbelievable things")], "doc_id long, text string")
    row = al.align_tokens(frame, A, B, with_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert sum(len(g.split("|")[0].split(",")) for g in row.groups.split(";")) == row.n_a
    assert al.align_tokens(frame, A, B).first().groups is None


def test_query_on_the_tables(spark, sf, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op13_token_alignment"](spark, sf).select(*COLUMNS).collect()), key=repr)
    assert got == expected(rows, plain)
