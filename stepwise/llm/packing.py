"""Bounded-space online packing of tokenised documents into fixed windows.

Each partition keeps at most `open_windows` windows open. A document's whole
windows are cut off first; the rest goes into the open window that it fills best.
If it fits in none and no more may be opened, the fullest is emitted, after the
head of the document has filled its gap where the gap is worth a cut. At the end of
the partition the windows left over are merged, and the last one is cut at powers
of two, so that it needs no padding. Nothing is shuffled; what a task holds is
bounded by the number of open windows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import textvec as tv
from .textvec import fold

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long, ids binary"
#: Sequence numbers of one partition.
PER_PARTITION = 1 << 36
#: Bytes of text that are cut into words at once.
CHUNK = 1 << 18


#: ASCII marks that a tokenizer splits from a letter or digit before them.
_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in '.,;:!?*$%&#)]"|']] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LETTER = _ALNUM.copy()
_LETTER[48:58] = False


def _byte_letters() -> dict[int, str]:
    """The character that byte-level BPE has for each byte: itself where printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordTokens:
    """Token ids of texts by way of their distinct words.

    For tokenizers that split at white space and between letters and marks: such a
    piece has the same ids in any text. Pieces of letters only (a-z and U+00C0 to
    U+00FF, A-Z folded if the tokenizer folds them) go straight to its model, others
    through the whole tokenizer. The memory is bounded: at `most` pieces (about 40 bytes each) it is emptied.
    """

    PROBES = ("word", "über", "naïve", "çà", "strasse")

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        whole = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        self.direct = all(whole(x.upper()) == whole(x) == self._of_letters(x.encode()) for x in self.PROBES)
        self._clear()

    def _of_letters(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(word.decode() if word.isascii() else "".join(map(self.letters.__getitem__, word)))]

    def _clear(self) -> None:
        self.known, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and the entry of each
        self.ids, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _pieces(self, data: np.ndarray, words: tv.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, only letters?, pieces before each word): words with the marks at their ends cut off."""
        at = np.arange(len(data))
        solid = np.maximum.accumulate(np.where(_TAIL[data], -1, at)) if len(data) else at
        cut = np.maximum(solid[words.end - 1] + 1, words.start)
        pair = np.zeros(len(data), bool)  # second bytes of the letters U+00C0 to U+00FF
        if len(data):
            pair[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        before = np.maximum(cut - 1, 0)
        cut = np.where((cut > words.start) & (_ALNUM[data[before]] | pair[before]), cut, words.end)
        two = cut < words.end
        first = np.concatenate(([0], np.cumsum(1 + two)))
        start, end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        start[first[:-1]], end[first[:-1]] = words.start, cut
        start[first[1:][two] - 1], end[first[1:][two] - 1] = cut[two], words.end[two]
        letter = _LETTER[data] | pair
        letter[:-1] |= pair[1:]
        bad = np.concatenate(([0], np.cumsum(~letter)))
        return start, end, (bad[end] == bad[start]) & self.direct, first

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in known, is it there?) of each hash."""
        at = np.searchsorted(self.known, keys)
        there = at < len(self.known)
        there[there] = self.known[at[there]] == keys[there]
        return at, there

    def _learn(self, words: list[bytes], plain: list[bool], keys: np.ndarray, at: np.ndarray) -> None:
        rest = iter(self.tokenizer.encode_batch_fast([w.decode() for w, p in zip(words, plain, strict=True) if not p], add_special_tokens=False))
        fresh = [self._of_letters(w) if p else next(rest).ids for w, p in zip(words, plain, strict=True)]
        fresh_entry = np.arange(len(self.known), len(self.known) + len(keys))
        self.known, self.entry = np.insert(self.known, at, keys), np.insert(self.entry, at, fresh_entry)
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(fresh), np.uint32)))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(np.fromiter(map(len, fresh), np.int64))))

    def texts(self, data: np.ndarray, offsets: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of each row, with `last` after them."""
        words = tv.Words(data, offsets)
        start, end, plain, first = self._pieces(data, words)
        folded = fold(data)
        hashes = np.where(plain, tv.HASH_A.ranges(folded, start, end), tv.HASH_B.ranges(data, start, end))
        distinct, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place, there = self._find(distinct)
        if len(self.known) + int((~there).sum()) > self.most:
            self._clear()
            place, there = self._find(distinct)
        new = np.flatnonzero(~there)
        if len(new):
            raw, low = data.tobytes(), folded.tobytes()
            at = index[new]
            only = plain[at].tolist()
            self._learn([(low if p else raw)[a:b] for a, b, p in zip(start[at].tolist(), end[at].tolist(), only, strict=True)], only, distinct[new], place[new])
            place, _ = self._find(distinct)
        entry = self.entry[place][inverse]
        size = self.bounds[entry + 1] - self.bounds[entry]
        sums = np.concatenate(([0], np.cumsum(size)))
        row_size = np.diff(sums[first[words.first]])
        bounds = np.concatenate(([0], np.cumsum(row_size + 1)))
        out = np.full(bounds[-1], last, np.uint32)
        take = np.arange(sums[-1]) + np.repeat(self.bounds[entry] - sums[:-1], size)
        hold = np.ones(len(out), bool)
        hold[bounds[1:] - 1] = False
        out[hold] = self.ids[take]
        return out, bounds


class Windows:
    """The open windows of one partition; take() and close() give finished sequences as lists of pieces."""

    def __init__(self, size: int, most: int, least_cut: int):
        self.size, self.most, self.least_cut = size, most, least_cut
        self.gaps: list[tuple[int, int]] = []  # (gap, number), ordered
        self.pieces: dict[int, list] = {}
        self.next = 0

    def take(self, doc, start: int, length: int) -> Iterator[list]:
        """Pieces are (doc, start, length)."""
        while length >= self.size:
            yield [(doc, start, self.size)]
            start, length = start + self.size, length - self.size
        if not length:
            return
        at = bisect_left(self.gaps, (length, -1))
        if at == len(self.gaps) and len(self.gaps) >= self.most:
            gap, number = self.gaps.pop(0)  # the fullest
            pieces = self.pieces.pop(number)
            if gap >= self.least_cut:
                pieces.append((doc, start, gap))
                start, length = start + gap, length - gap
            yield pieces
            at = bisect_left(self.gaps, (length, -1))
        if at == len(self.gaps):
            gap, number, pieces = self.size, self.next, []
            self.next += 1
        else:
            gap, number = self.gaps.pop(at)
            pieces = self.pieces.pop(number)
        pieces.append((doc, start, length))
        if gap == length:
            yield pieces
        else:
            insort(self.gaps, (gap - length, number))
            self.pieces[number] = pieces

    def close(self) -> Iterator[list]:
        """Merge the windows left over; only the last piece of a sequence is cut."""
        left = [p for _, number in self.gaps for p in self.pieces[number]]
        total = sum(p[2] for p in left)
        while left:
            room = self.size if total >= self.size else 1 << (total.bit_length() - 1)
            total -= room
            pieces = []
            while room:
                doc, start, length = left.pop(0)
                pieces.append((doc, start, min(room, length)))
                if length > room:
                    left.insert(0, (doc, start + room, length - room))
                room -= pieces[-1][2]
            yield pieces


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, last: int = 2, open_windows: int = 64, least_cut: int = 32, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length, ids.

    A document's ids are those of its text and then `last`. padded_length is the
    length of its sequence after padding: `size`, or a smaller power of two that the
    sequence fills exactly. ids (little-endian, unsigned 32 bits; with_ids only) are
    the piece's ids. Null and empty texts are the single id `last`; a repeated
    doc_id is a document of its own; an empty table gives an empty one; other
    columns are ignored. `tokenizer` is the path of a tokenizer that splits at white
    space, readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, windows = WordTokens(tokenizer), Windows(size, open_windows, least_cut)
        number = TaskContext.get().partitionId() * PER_PARTITION
        schema = pa.schema([*[(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length")], ("ids", pa.binary())])
        rows: list[tuple] = []

        def finish(sequences) -> None:
            nonlocal number
            for pieces in sequences:
                offset, total = 0, sum(p[2] for p in pieces)
                full = size if total & (total - 1) else total
                for (doc, ids, at, n), start, length in pieces:  # ids: those of the document from `at` on
                    raw = ids[start - at : start - at + length].tobytes()
                    rows.append((doc, start, length, zlib.crc32(raw), n, number, offset, full, raw if with_ids else None))
                    offset += length
                number += 1

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows.clear()
            return out

        for given in batches:
            ids = given.column("doc_id").to_pylist()
            text = given.column("text")
            for a, b in tv.pieces(text, CHUNK):
                got, bounds = tokens.texts(*tv.strings(text.slice(a, b - a)), last)
                for k, doc in enumerate(ids[a:b]):
                    mine = got[bounds[k] : bounds[k + 1]]
                    n, whole = len(mine), len(mine) // size * size
                    finish(windows.take((doc, mine, 0, n), 0, whole))
                    finish(windows.take((doc, mine[whole:].copy(), whole, n), whole, n - whole))
                del got, bounds, mine
                tv.release()
                if rows:
                    yield batch()
        finish(windows.close())
        del tokens
        tv.release()
        if rows:
            yield batch()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
