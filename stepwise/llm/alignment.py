"""Which tokens of two tokenizers cover the same bytes, and how often each pair of ids does.

A task tokenises whole texts with both tokenizers and checks that both give the bytes of
the text. Byte offsets where tokens of both end are shared ends; those before a token
that starts with a space in both tokenizers cut a text into windows, which are short and
repeat. Windows are recognised by their id tuples and aligned once a block (some MB of
text); a text becomes a sequence of window numbers. A block tells which id pairs its
texts link and how many texts do; counts are summed over all blocks, and each block gets
those of its own pairs back, so neither texts nor tokens are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

#: Text that is tokenised at once, and text and distinct windows of a block.
CHUNK, BLOCK_BYTES, BLOCK_WINDOWS = 1 << 19, 32 << 20, 200_000
#: What a row counts besides its text.
ROW_BYTES = 64
#: Blocks of one partition.
PER_PARTITION = 1 << 24
BLOCKS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, used binary, pairs binary, windows binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _plain_bytes(token: str, byte_of: dict[str, int]) -> bytes:
    """The bytes of an entry of a byte-level vocabulary."""
    return bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()


class Vocabulary:
    """Token bytes by id, as one array, and whether they start with a space."""

    def __init__(self, tokens: dict[int, bytes]):
        each = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.flat = np.frombuffer(b"".join(each), np.uint8)
        self.length = np.array([len(x) for x in each], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.spaced = np.array([x.startswith(b" ") for x in each])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids in order."""
        return self.flat[_ranges(self.start[ids], self.length[ids])]


#: How byte-level BPE splits a text before merging (a fixed value of the format).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizers:
    """A byte-level BPE of the tokenizers library (A) and a sentencepiece model (B).

    A vocabulary whose ids are the ranks of its merges is encoded by tiktoken, which is several
    times as fast; the two give the same ids for every code point, and PROBES are compared at loading.
    """

    PROBES = (" don't  stop\n\n 1234,5 naïve — 你好\u00a0\t¿x?", " <|endoftext|>   ''s aAbB\r\n.", " zzzzqqqqxxxx" * 40)

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        from .packing import _byte_letters

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in _byte_letters().items()}
        self.of_a = Vocabulary({i: _plain_bytes(t, byte_of) for t, i in self.a.get_vocab(with_added_tokens=True).items()})
        pieces = ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        plain = {_plain_bytes(t, byte_of): i for t, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in byte_of for c in t)}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        ranks = {t: i for t, i in plain.items() if t.decode(errors="replace") not in special}
        self.ranked = self._ranked(ranks)
        self.of_b = Vocabulary({i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces})

    def _ranked(self, ranks: dict[bytes, int]):
        from tiktoken import Encoding

        if sorted(ranks.values()) != list(range(len(ranks))):
            return None
        found = Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        same = all(found.encode_ordinary(x) == self.a.encode(x, add_special_tokens=False).ids for x in self.PROBES)
        return found if same else None

    def _of_a(self, texts: list[str]) -> list[np.ndarray]:
        if self.ranked:
            return [np.array(self.ranked.encode_ordinary(t), np.uint32) for t in texts]
        return [np.array(x.ids, np.uint32) for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def texts(self, texts: list[bytes]) -> tuple[Tokens, Tokens]:
        """Ids of A and B; none for a text that is empty or that one of them doesn't give back byte by byte."""
        plain = [t.decode(errors="replace") for t in texts]
        both = (self._of_a([" " + t for t in plain]), [np.array(x, np.uint32) for x in self.b.encode(plain, num_threads=1)])
        good = np.array([len(t) > 0 for t in texts], bool)
        for ids, of in zip(both, (self.of_a, self.of_b), strict=True):
            got = of.joined(np.concatenate(ids)).tobytes() if ids else b""
            if got != b"".join(b" " + t for t in texts):  # else all are good at once
                good &= [of.joined(x).tobytes() == b" " + t for x, t in zip(ids, texts, strict=True)]
        return tuple(_tokens([x if g else x[:0] for x, g in zip(ids, good.tolist(), strict=True)]) for ids in both)


class Tokens(NamedTuple):
    """ids of all texts, and where each text's start, with their number at the end."""

    ids: np.ndarray
    first: np.ndarray


def _tokens(each: list[np.ndarray]) -> Tokens:
    first = np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)
    return Tokens(np.concatenate(each).astype(np.int64) if each else np.zeros(0, np.int64), first)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each size."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Block:
    """The distinct windows of some texts, by their id tuples, and the pairs that they link."""

    #: What follows an id in the text of groups.
    MARKS = (",", "|", ";", "")

    def __init__(self, of_a: Vocabulary, of_b: Vocabulary):
        self.of_a, self.of_b = of_a, of_b
        self.number: dict[bytes, int] = {}
        self.groups: list[str] = []  # of each window
        self.n_groups, self.n_links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)  # numbers of pairs, window by window
        self.pair_number: dict[int, int] = {}
        self.texts = np.zeros(0, np.int64)  # how many link each pair
        self.size = 0
        self.said = [f"{i}{m}" for i in range(max(len(of_a.length), len(of_b.length))) for m in self.MARKS]

    def chunk(self, a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(window numbers of all texts, where each text's start): cut at shared ends before space-marked tokens."""
        size_a, size_b = self.of_a.length[a.ids], self.of_b.length[b.ids]
        start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        # texts have the same bytes on both sides, so offsets over the whole chunk agree, and each text starts with a space
        mark_a, mark_b = np.flatnonzero(self.of_a.spaced[a.ids]), np.flatnonzero(self.of_b.spaced[b.ids])
        _, at_a, at_b = np.intersect1d(start_a[mark_a], start_b[mark_b], assume_unique=True, return_indices=True)
        cut_a, cut_b = np.append(mark_a[at_a], len(a.ids)), np.append(mark_b[at_b], len(b.ids))
        n_a, n_b = np.diff(cut_a), np.diff(cut_b)
        hashes = _range_hash(a.ids, cut_a, 1) + _range_hash(b.ids, cut_b, 2)
        _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        same = _equal(a.ids, cut_a, n_a, index[inverse]) & _equal(b.ids, cut_b, n_b, index[inverse])
        odd = np.flatnonzero(~same)  # a hash that two windows share
        some = np.concatenate((index, odd))
        one_a, one_b = (cut_a[some], n_a[some]), (cut_b[some], n_b[some])
        keys = self._keys(a.ids[_ranges(*one_a)], one_a[1], b.ids[_ranges(*one_b)], one_b[1])
        fresh = []
        for k, key in enumerate(keys):
            if key not in self.number:
                self.number[key] = len(self.number)
                fresh.append(k)
        if fresh:
            self._align(a.ids[_ranges(cut_a[some[fresh]], n_a[some[fresh]])], n_a[some[fresh]], b.ids[_ranges(cut_b[some[fresh]], n_b[some[fresh]])], n_b[some[fresh]])
        numbers = np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))
        out = numbers[inverse]
        out[odd] = numbers[len(index) :]
        return out, np.searchsorted(cut_a[:-1], a.first)

    @staticmethod
    def _keys(ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray) -> list[bytes]:
        """The id tuples of windows: those of A, a mark, those of B."""
        size = n_a + 1 + n_b
        ends = np.cumsum(size)
        flat = np.full(ends[-1] if len(ends) else 0, 0xFFFFFFFF, "<u4")
        flat[_ranges(ends - size, n_a)] = ids_a
        flat[_ranges(ends - n_b, n_b)] = ids_b
        raw, to = flat.tobytes(), (4 * ends).tolist()
        return [raw[x:y] for x, y in zip([0, *to], to, strict=False)]

    def _align(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        """Align new windows: links start where a token of either side starts, groups where tokens of both do."""
        size_a, size_b = self.of_a.length[a], self.of_b.length[b]
        start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        window_a, window_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        starts = np.union1d(start_a, start_b)
        link_a, link_b = np.searchsorted(start_a, starts, "right") - 1, np.searchsorted(start_b, starts, "right") - 1
        pairs, inverse = np.unique((a[link_a] << 32) | b[link_b], return_inverse=True)
        numbers = np.array([self.pair_number.setdefault(p, len(self.pair_number)) for p in pairs.tolist()], np.int64)
        self.links = np.concatenate((self.links, numbers[inverse]))
        self.n_links = np.concatenate((self.n_links, np.bincount(window_a[link_a], minlength=len(n_a))))
        shared = np.intersect1d(start_a, start_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, start_a, "right") - 1, np.searchsorted(shared, start_b, "right") - 1
        self.n_groups = np.concatenate((self.n_groups, np.bincount(window_b[np.searchsorted(start_b, shared)], minlength=len(n_b))))
        mark_a = np.append(group_a[1:] != group_a[:-1], True).astype(np.int64)  # | after the last of a group
        mark_b = np.append(group_b[1:] != group_b[:-1], True) * 2  # ; after the last of a group
        mark_b[np.cumsum(n_b) - 1] = 3  # nothing after the last of a window
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        said = [self.said[k] for k in np.concatenate((4 * a + mark_a, 4 * b + mark_b))[order].tolist()]
        to = np.cumsum(n_a + n_b).tolist()
        self.groups += ["".join(said[x:y]) for x, y in zip([0, *to], to, strict=False)]

    def count(self, used: np.ndarray, first: np.ndarray) -> None:
        """Count the pairs that each text links once."""
        text, window = tv.unique_pairs(np.repeat(np.arange(len(first) - 1), np.diff(first)), used)
        size = self.n_links[window]
        pairs = self.links[_ranges((np.cumsum(self.n_links) - self.n_links)[window], size)]
        key = np.unique((np.repeat(text, size) << 32) | pairs)
        more = np.zeros(len(self.pair_number) - len(self.texts), np.int64)
        self.texts = np.concatenate((self.texts, more)) + np.bincount(key & 0xFFFFFFFF, minlength=len(self.pair_number))


def _range_hash(ids: np.ndarray, cut: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each window's ids; equal hashes are verified by _equal."""
    if len(cut) < 2:
        return np.zeros(0, np.uint64)
    place = np.arange(len(ids)) - np.repeat(cut[:-1], np.diff(cut))
    mixed = tv.mix(ids.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32)) + np.uint64(seed << 60))
    return np.add.reduceat(mixed, cut[:-1])


def _equal(ids: np.ndarray, cut: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the ids of each window are those of the other window."""
    out = size == size[other]
    some = np.flatnonzero(out)
    n = size[some]
    differ = ids[_ranges(cut[some], n)] != ids[_ranges(cut[other[some]], n)]
    bad = np.bincount(np.repeat(np.arange(len(some)), n), differ, len(some)) > 0
    out[some[bad]] = False
    return out


def blocks(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """Rows of texts (their windows in `used`) and, for each block, one row with its pairs and one list of pairs for each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Tokenizers(path_a, path_b)
        block, number = Block(both.of_a, both.of_b), TaskContext.get().partitionId() * PER_PARTITION
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in BLOCKS.split(", ")]
        pack = zstandard.ZstdCompressor(level=1)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        def close() -> pa.RecordBatch:
            ids = np.fromiter(block.pair_number, np.int64, len(block.pair_number))
            pairs = np.column_stack([ids >> 32, ids & 0xFFFFFFFF, block.texts]).astype("<u4").tobytes()
            windows = len(block.groups).to_bytes(4, "little") + block.n_links.astype("<u4").tobytes() + block.links.astype("<u4").tobytes()
            return batch([(number, *[None] * 8, pairs, pack.compress(windows))])

        for given in batches:
            doc_ids, column = given.column("doc_id").to_pylist(), given.column("text")
            for low, high in tv.pieces(column, CHUNK):
                data, offsets = tv.strings(column.slice(low, high - low))
                raw, ends = data.tobytes(), offsets.tolist()
                a, b = both.texts([raw[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)])
                used, first = block.chunk(a, b)
                block.count(used, first)
                groups, links = (np.concatenate(([0], np.cumsum(x[used])))[first] for x in (block.n_groups, block.n_links))
                rows = []
                for k, doc in enumerate(doc_ids[low:high]):
                    mine = used[first[k] : first[k + 1]]
                    text = ";".join(map(block.groups.__getitem__, mine.tolist()))
                    digest = hashlib.sha256(text.encode()).hexdigest() if len(mine) else ""
                    counts = (int(x[k + 1] - x[k]) for x in (a.first, b.first, groups, links))
                    rows.append((number, doc, *counts, digest, text if with_groups else None, pack.compress(mine.astype("<u4").tobytes()), None, None))
                yield batch(rows)
                block.size += len(raw) + sum(ROW_BYTES + len(r[7] or "") for r in rows)
                del a, b, used, rows, raw, data
                if block.size >= BLOCK_BYTES or len(block.groups) >= BLOCK_WINDOWS:
                    yield close()
                    block, number = Block(both.of_a, both.of_b), number + 1
                tv.release()
        if block.size:
            yield close()

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each pair of a block: its number there, its ids, and how many texts of the block link it."""
    for given in batches:
        for block, raw in zip(given.column("block").to_pylist(), given.column("pairs").to_pylist(), strict=True):
            a, b, texts = np.frombuffer(raw, "<u4").reshape(-1, 3).astype(np.int64).T
            n = len(a)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array(np.arange(n)), pa.array(a), pa.array(b), pa.array(texts)], names=["block", "at", "a", "b", "texts"])


def _answered(texts: pa.Table, found: pa.Table) -> pa.Table:
    """The texts of one block with the counts of its pairs."""
    at = found["at"].to_numpy()
    count, best = np.zeros((2, len(at)), np.int64)
    count[at], best[at] = found["n"].to_numpy(), found["best"].to_numpy()
    unpack = zstandard.ZstdDecompressor()
    raw = unpack.decompress(texts.filter(texts["windows"].is_valid())["windows"][0].as_py())
    n = int.from_bytes(raw[:4], "little")
    size, flat = np.frombuffer(raw, "<u4", n, 4).astype(np.int64), np.frombuffer(raw, "<u4", offset=4 + 4 * n)
    count_of, best_of = (np.add.reduceat(v[flat], np.cumsum(size) - size) if n else v for v in (count, best))
    texts = texts.filter(texts["windows"].is_null())
    used = [np.frombuffer(unpack.decompress(x.as_py()), "<u4") for x in texts["used"]]
    columns = {c: texts[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")}
    columns |= {name: pa.array([int(of[u].sum()) for u in used], pa.int64()) for name, of in (("n_best", best_of), ("count_sum", count_of))}
    return pa.table({c.split()[0]: columns[c.split()[0]] for c in RESULT.split(", ")})


def align_tokens(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """One row for each text: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups.

    n_a and n_b are the tokens of space and text by A and of the text by B, which adds the
    space; n_groups the cuts at shared ends; n_links the pairs of token occurrences whose
    bytes overlap. A pair of ids counts as often as there are texts in the corpus that link
    it; count_sum adds that up over links, n_best counts the links whose count no other
    pair of the same A id exceeds. groups_sha256 is that of `a1,a2|b1;a3|b2,b3`, which
    groups holds with_groups only. Null and empty texts, and those whose bytes one of the
    tokenizers doesn't give back, have zeros and ''. A repeated doc_id, or none, is a
    text of its own; an empty table gives an empty one; other columns are ignored.
    """
    found = blocks(docs, path_a, path_b, with_groups).checkpoint()  # tokenised once
    pairs = found.filter("pairs IS NOT NULL").select("block", "pairs").mapInArrow(_pairs, "block long, at long, a long, b long, texts long")
    counts = pairs.groupBy("a", "b").agg(F.sum("texts").alias("n"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    judged = counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    answers = pairs.join(judged, ["a", "b"]).select("block", "at", "n", "best")
    return found.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answered, RESULT)
