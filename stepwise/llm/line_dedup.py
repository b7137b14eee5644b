"""Line deduplication by sharded minimal perfect hashes.

1. Each block of documents sends its distinct line hashes to their shards.
2. A shard builds a minimal perfect hash over the distinct hashes it got. Its index
   stands for three arrays: a 32-bit fingerprint of the line, the number of documents
   that hold it, and the smallest of them. These arrays are published, a row a shard.
3. The blocks' lines probe the published arrays, each in its shard, and the answer to a
   block is two bits' worth for each of its distinct lines, in the order it sent them:
   does the line recur, and does the block hold its first document?

Lines themselves are never joined or moved. A line that all documents hold is one
message from each block, and blocks grow with the input (see blocks.counts).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textvec as tv
from .blocks import BLOCK_BYTES, NO_ID, SHARD_BYTES, answer, by_shard, counts, doc_ids, in_blocks, kept_strings, padded, text_bytes, text_chunks, unpack

PROBES = "shard int, block int, hashes binary, prints binary, docs binary, times binary"
ARRAYS = "shard int, levels binary, ranks binary, prints binary, counts binary, firsts binary, odd_keys binary, odd_prints binary, odd_counts binary, odd_firsts binary"
ANSWERS = "block int, shard int, answers binary"
#: Answers: the line goes everywhere in the block; it stays in the first of its documents there.
GOES, FIRST_HERE = 1, 2


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys.

    On each level the keys left over take a place by a fresh hash; a key alone at
    its place keeps it. The rank of that place among all places taken is the index.
    """

    SPARE = 1.5

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.size = 0
        left = keys
        while len(left):
            n = int(len(left) * self.SPARE) + 1
            at = self._place(left, len(self.levels), n)
            alone = np.bincount(at, minlength=n) == 1
            rank = np.cumsum(alone, dtype=np.int32)
            self.levels.append((np.where(alone, rank - 1, -1).astype(np.int32), self.size))
            self.size += int(rank[-1])
            left = left[~alone[at]]

    @staticmethod
    def _place(keys: np.ndarray, level: int, n: int) -> np.ndarray:
        return (tv.mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) % np.uint64(n)).astype(np.int64)

    def to_bytes(self) -> tuple[bytes, bytes]:
        """Places of each level; ranks of all places."""
        ranks = np.concatenate([r for r, _ in self.levels]) if self.levels else np.zeros(0, np.int32)
        return np.array([x for r, base in self.levels for x in (len(r), base)], np.int64).tobytes(), ranks.tobytes()

    @classmethod
    def from_bytes(cls, levels: bytes, ranks: bytes) -> PerfectHash:
        out, all_ranks, at = cls(np.zeros(0, np.uint64)), np.frombuffer(ranks, np.int32), 0
        for n, base in np.frombuffer(levels, np.int64).reshape(-1, 2).tolist():
            out.levels.append((all_ranks[at : at + n], base))
            at += n
        return out

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; any number, or -1, for keys that it wasn't built from."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (rank, base) in enumerate(self.levels):
            got = rank[self._place(keys[todo], level, len(rank))]
            out[todo[got >= 0]] = got[got >= 0] + base
            todo = todo[got < 0]
        return out


class Lines:
    """Lines of padded rows: byte ranges (without the line feed), row, and key hashes of those long enough."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int):
        self.data, self.offsets = padded(data, offsets, 10)
        self.end = np.flatnonzero(self.data == 10)
        self.start = np.concatenate(([0], self.end[:-1] + 1)) if len(self.end) else self.end
        first = np.searchsorted(self.end, self.offsets)
        self.count = np.diff(first)
        self.row = np.repeat(np.arange(len(self.count)), self.count)
        solid = np.flatnonzero(~tv._WS[self.data])
        a = np.searchsorted(solid, self.start)
        b = np.searchsorted(solid, self.end)
        some = b > a
        points = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=points[1:])
        left, right = np.zeros_like(a), np.zeros_like(a)
        left[some], right[some] = solid[a[some]], solid[b[some] - 1] + 1
        self.keyed = np.flatnonzero(some & (points[right] - points[left] >= least))
        low = tv.lower(self.data)
        self.hash = tv.HASH_A.ranges(low, left[self.keyed], right[self.keyed])
        self.print = (tv.HASH_B.ranges(low, left[self.keyed], right[self.keyed]) >> np.uint64(32)).astype(np.uint32)


#: Marks a number of documents that leaves out the one of rows without an id, which several blocks may have.
WITHOUT_ID = 1 << 31


def _grouped(hashes: np.ndarray, prints: np.ndarray, docs: np.ndarray, times: np.ndarray | None = None):
    """Distinct (hash, fingerprint), ordered: smallest document, number of documents, and the group of each item.

    Without times, items are lines, of which a document may have several, and rows without an id are marked, not counted;
    with them, items are blocks' numbers and marks, and those rows count as one document.
    """
    order = np.lexsort((docs, prints, hashes))
    inverse = np.empty(len(order), np.int64)
    hashes, prints, docs = hashes[order], prints[order], docs[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (prints[1:] != prints[:-1])
    at = np.flatnonzero(new)
    inverse[order] = np.cumsum(new) - 1
    if times is None:
        fresh = new.copy()
        fresh[1:] |= docs[1:] != docs[:-1]
        none = docs == NO_ID
        fresh &= ~none
    else:
        fresh, none = times[order] & (WITHOUT_ID - 1), times[order] >= WITHOUT_ID
    n = np.add.reduceat(fresh.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    if len(at):
        n += np.maximum.reduceat(none.astype(np.int64), at) * (WITHOUT_ID if times is None else 1)
    return hashes[at], prints[at], docs[at], n, inverse


class BlockLines:
    """The keyed lines of a block's rows, chunk by chunk, and their distinct keys."""

    def __init__(self, table: pa.Table, least: int):
        self.ids = doc_ids(table) if table.num_rows else np.zeros(0, np.int64)
        got = [[np.zeros(0, t)] for t in (np.uint64, np.uint32, np.int64)]
        for a, b, data, offsets in text_chunks(table.select(["text"])):
            lines = Lines(data, offsets, least)
            for to, what in zip(got, (lines.hash, lines.print, self.ids[a:b][lines.row[lines.keyed]]), strict=True):
                to.append(what)
        hashes, prints, self.docs = (np.concatenate(x) for x in got)
        self.hashes, self.prints, self.first, self.times, self.of = _grouped(hashes, prints, self.docs)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, pa.int32() if t == "int" else pa.binary()) for c, (_, t) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def _send(n_shards: int, least: int):
    def send(table: pa.Table) -> pa.Table:
        own = BlockLines(table, least)
        block = table["block"][0].as_py()
        return _table([(s, block, own.hashes[i].tobytes(), own.prints[i].tobytes(), own.first[i].tobytes(), own.times[i].astype(np.uint32).tobytes()) for s, i in by_shard(own.hashes, n_shards)], PROBES)

    return send


class Arrays:
    """The published arrays of a shard.

    Two lines with one 64-bit hash and different fingerprints (not seen in practice)
    can't share an index; the second and later ones stand in a short list beside it.
    """

    def __init__(self, mph: PerfectHash, *arrays: np.ndarray):
        self.mph = mph
        self.prints, self.counts, self.firsts, self.odd_keys, self.odd_prints, self.odd_counts, self.odd_firsts = arrays

    @classmethod
    def build(cls, hashes: np.ndarray, prints: np.ndarray, docs: np.ndarray, times: np.ndarray) -> Arrays:
        keys, marks, first, n, _ = _grouped(hashes, prints, docs, times)
        lead = np.ones(len(keys), bool)
        lead[1:] = keys[1:] != keys[:-1]
        mph = PerfectHash(keys[lead])
        place = mph.index(keys[lead])
        arrays = [np.zeros(mph.size, t) for t in (np.uint32, np.int64, np.int64)]
        for array, values in zip(arrays, (marks, n, first), strict=True):
            array[place] = values[lead]
        return cls(mph, *arrays, *(x[~lead] for x in (keys, marks, n, first)))

    def row(self, shard: int) -> tuple:
        return (shard, *self.mph.to_bytes(), *(x.tobytes() for x in (self.prints, self.counts, self.firsts, self.odd_keys, self.odd_prints, self.odd_counts, self.odd_firsts)))

    @classmethod
    def of_row(cls, row: dict) -> Arrays:
        types = {"prints": np.uint32, "counts": np.int64, "firsts": np.int64, "odd_keys": np.uint64, "odd_prints": np.uint32, "odd_counts": np.int64, "odd_firsts": np.int64}
        return cls(PerfectHash.from_bytes(row["levels"], row["ranks"]), *(np.frombuffer(row[c], t) for c, t in types.items()))

    def probe(self, hashes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of documents that hold each line, and the smallest; 0 for lines that aren't there."""
        index = self.mph.index(hashes)
        known = index >= 0
        hit = known & (self.prints[np.where(known, index, 0)] == prints) if len(self.prints) else np.zeros(len(hashes), bool)
        n, first = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        n[hit], first[hit] = self.counts[index[hit]], self.firsts[index[hit]]
        for key, mark, times, doc in zip(self.odd_keys, self.odd_prints, self.odd_counts, self.odd_firsts, strict=True):
            here = (hashes == key) & (prints == mark)
            n[here], first[here] = times, doc
        return n, first


def _publish(table: pa.Table) -> pa.Table:
    columns = [unpack(table[c], t)[0] for c, t in (("hashes", np.uint64), ("prints", np.uint32), ("docs", np.int64), ("times", np.uint32))]
    return _table([Arrays.build(*columns).row(table["shard"][0].as_py())], ARRAYS)


def _probe(probes: pa.Table, published: pa.Table) -> pa.Table:
    """The answers of one shard's arrays to all blocks that ask it."""
    rows = []
    if published.num_rows:
        arrays = Arrays.of_row(published.to_pylist()[0])
        for row in probes.to_pylist():
            n, first = arrays.probe(np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["prints"], np.uint32))
            here = np.frombuffer(row["docs"], np.int64) == first
            rows.append((row["block"], row["shard"], np.where(n < 2, 0, np.where(here, FIRST_HERE, GOES)).astype(np.uint8).tobytes()))
    return _table(rows, ANSWERS)


def _apply(n_shards: int, least: int, carry: list[str]):
    def apply(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = BlockLines(table, least)
        said = dict(zip(answers["shard"].to_pylist(), answers["answers"].to_pylist(), strict=True))
        verdict = np.zeros(len(own.hashes), np.uint8)
        for s, i in by_shard(own.hashes, n_shards):
            if s in said:
                verdict[i] = np.frombuffer(said[s], np.uint8)
        goes = (verdict[own.of] == GOES) | ((verdict[own.of] == FIRST_HERE) & (own.docs != own.first[own.of]))
        texts, n_lines, n_dropped, done = [], [], [], 0
        for a, b, data, offsets in text_chunks(table.select(["text"])):
            lines = Lines(data, offsets, least)
            drop = np.zeros(len(lines.row), bool)
            drop[lines.keyed] = goes[done : done + len(lines.keyed)]
            done += len(lines.keyed)
            change = np.zeros(len(lines.data) + 1, np.int32)
            np.add.at(change, lines.start[drop], 1)
            np.add.at(change, lines.end[drop] + 1, -1)
            keep = np.cumsum(change[:-1]) == 0
            texts.append(kept_strings(lines.data, lines.offsets, keep))
            n_lines.append(lines.count)
            n_dropped.append(np.bincount(lines.row[drop], minlength=b - a))
        join = lambda x: pa.array(np.concatenate(x) if x else [], pa.int64())
        return pa.table({c: table[c] for c in carry} | {"doc_id": table["doc_id"], "text": pa.chunked_array(texts, pa.string()), "n_lines": join(n_lines), "n_dropped": join(n_dropped)})

    return apply


def drop_repeated_lines(docs: DataFrame, least: int = 10, carry: Sequence[str] = (), block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The columns of `carry` as they are, doc_id, text (the lines left, joined by a line feed), n_lines (before) and n_dropped.

    A line's key is the line without white space at its ends, A-Z in lower case. Keys
    of at least `least` code points that two or more documents hold lose their lines
    in all but the smallest doc_id. Null and empty texts are one empty line, which
    stays; several rows of one doc_id count as one document, and so do all rows without
    a doc_id, which comes after all others; an empty table gives an empty one; other
    columns are ignored.
    """
    n_blocks, n_shards = counts(text_bytes(docs), block_bytes, shard_bytes)
    blocks = in_blocks(docs, n_blocks, "doc_id", "text", *carry)
    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    probes = blocks.groupBy("block").applyInArrow(_send(n_shards, least), PROBES)
    arrays = probes.groupBy("shard").applyInArrow(_publish, ARRAYS)
    answers = probes.groupBy("shard").cogroup(arrays.groupBy("shard")).applyInArrow(_probe, ANSWERS)
    return answer(blocks, answers, _apply(n_shards, least, list(carry)), f"{fields}doc_id long, text string, n_lines long, n_dropped long")
