"""Vectorised text helpers for Arrow batches: words, hashes, shingles.

Everything works on the UTF-8 bytes of a whole string column at once, so per-row
Python is not needed. Hashes are 64-bit polynomial hashes of bytes (random byte
weights, odd base) finished by a mixing step; they depend on nothing but the bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_LIBC = ctypes.CDLL(None)
#: Bytes of text handled at once; the temporary arrays take about 60 times as much.
CHUNK_BYTES = 1 << 20

_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64 (a bijection)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _table(seed: int, n: int = 256) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15))


class Hasher:
    """Hashes of byte ranges of one buffer by prefix sums."""

    def __init__(self, seed: int):
        self.table = _table(seed * 1000 + 7)
        self.base = int(_table(seed * 1000 + 3, 1)[0]) | 1
        self.inv = pow(self.base, -1, 1 << 64)
        self._up = self._down = np.ones(1, U64)

    def _powers(self, n: int) -> None:
        if len(self._up) < n:
            size = max(n, 1 << 16)
            for name, base in (("_up", self.base), ("_down", self.inv)):
                out = np.empty(size, U64)
                out[0] = 1
                have = 1
                while have < size:  # doubling
                    take = min(have, size - have)
                    out[have : have + take] = out[:take] * U64(pow(base, have, 1 << 64))
                    have += take
                setattr(self, name, out)

    def ranges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One hash for each data[start:end]; empty ranges get one constant."""
        self._powers(len(data) + 1)
        prefix = np.zeros(len(data) + 1, U64)
        np.cumsum(self.table[data] * self._up[: len(data)], out=prefix[1:])
        got = (prefix[end] - prefix[start]) * self._down[start]
        return mix(got + (end - start).astype(U64) * U64(0x9E3779B97F4A7C15))


HASH_A, HASH_B = Hasher(1), Hasher(2)


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string column; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes (at least one row each)."""
    _, offsets = strings(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to
    release()


def release() -> None:
    """Give freed memory back to the system: Python workers live on and keep it otherwise, stage after stage."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes stay."""
    return _LOWER[data]


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z and the letters U+00C0 to U+00DE in lower case."""
    out = lower(data)
    if len(out):
        second = np.zeros(len(out), bool)
        second[1:] = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[second] += 0x20
    return out


class Words:
    """Words (runs without ASCII white space) of rows.

    start, end: byte ranges; row: the row of each word; first: index of each
    row's first word, with the total at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        solid = ~_WS[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0], before[1:] = False, solid[:-1]
            after[-1], after[:-1] = False, solid[1:]
        self.data = data
        self.start = np.flatnonzero(solid & (~before | edge[:-1]))
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self, hasher: Hasher = HASH_A) -> np.ndarray:
        return hasher.ranges(self.data, self.start, self.end)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive items (length n-k+1); may cross rows."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    weight = _table(77, k) | U64(1)
    out = np.zeros(n, U64)
    for j in range(k):
        out += hashes[j : j + n] * weight[j]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive items (length n-w+1)."""
    if len(x) < w:
        return x[:0]
    have, got = 1, x
    while have < w:
        step = min(have, w - have)
        got = np.minimum(got[:-step], got[step:])
        have += step
    return got


def shingles(words: Words, k: int, hasher: Hasher = HASH_A) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each k-word shingle; a row with 1 to k-1 words has its whole sequence as one."""
    h = words.hashes(hasher)
    full = runs(h, k)
    ok = words.row[: len(full)] == words.row[k - 1 :] if len(full) else np.zeros(0, bool)
    rows, got = [words.row[: len(full)][ok]], [full[ok]]
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        total = np.zeros(len(short), U64)
        weight = _table(78, k) | U64(1)
        for j in range(k - 1):
            has = words.count[short] > j
            total[has] += h[words.first[short[has]] + j] * weight[j]
        rows.append(short)
        got.append(mix(total + words.count[short].astype(U64)))
    return np.concatenate(rows), np.concatenate(got)


def unique_pairs(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), ordered by row, then value."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[keep], value[keep]
