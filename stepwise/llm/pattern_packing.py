"""Best-fit packing by length patterns, fitted with non-negative least squares.

Documents are tokenised once; only those longer than a sequence are cut. The histogram
of piece lengths has one row for each length, so the plan is made from at most `size`
numbers, however large the corpus: patterns of one to three lengths that fill a sequence
are enumerated, non-negative least squares fits how often each repeats, the counts are
rounded without exceeding what is there, and what is left is packed best-fit by falling
length, whole groups of equal sequences at a time. The plan says, for runs of the pieces
of a length, in which sequence and place they go. A piece finds its number among the
pieces of its length from counts by (partition, length) and their running sums, so
no length is gathered in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textvec as tv
from .packing import CHUNK, WordTokens

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary"
#: Bits of a piece's number among those of its length.
NUMBER_BITS = 48


class Patterns(NamedTuple):
    """parts: three lengths for each pattern, 0 where it has fewer; waste: what a pattern leaves empty."""

    parts: np.ndarray
    waste: np.ndarray


def patterns(histogram: np.ndarray, slack: int, most: int) -> Patterns:
    """Patterns of one or two lengths that occur, and for each two the third that fills best, with at most `slack` left empty.

    Of more than `most`, those of the most frequent lengths stay (by the mean logarithm of the counts and a
    fixed noise). They only steer the fit: pieces that no pattern takes are packed after it.
    """
    lengths, size = np.flatnonzero(histogram), len(histogram) - 1
    found = []
    for k, a in enumerate(lengths):
        rest = size - a
        if rest <= slack:
            found.append(np.array([[a, 0, 0]]))
        b = lengths[k:]
        b = b[b <= rest]
        full = b[rest - b <= slack]
        found.append(np.column_stack([np.full(len(full), a), full, np.zeros_like(full)]))
        at = np.searchsorted(lengths, rest - b, "right") - 1
        c = np.where(at >= 0, lengths[np.maximum(at, 0)], 0)
        good = (c >= b) & (rest - b - c <= slack)
        found.append(np.column_stack([np.full(int(good.sum()), a), b[good], c[good]]))
    parts = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    if len(parts) > most:
        weight = np.log1p(histogram)[parts].sum(1) / (parts > 0).sum(1)  # histogram[0] is 0
        noise = tv.mix(np.arange(len(parts), dtype=np.uint64)).astype(float) / 2.0**64
        parts = parts[np.sort(np.argpartition(-weight - noise, most)[:most])]
    return Patterns(parts, size - parts.sum(1))


def fit(found: Patterns, histogram: np.ndarray, rounds: int, penalty: float = 0.05) -> np.ndarray:
    """How often each pattern repeats: non-negative least squares by accelerated projected gradients.

    One equation for each length (what the patterns take is what there is), one for each pattern's waste (it is nothing).
    """
    n, m = len(found.parts), len(histogram)
    if not n:
        return np.zeros(0)
    index, used = found.parts.ravel(), (found.parts > 0).ravel()
    cost = (penalty * found.waste) ** 2

    def take(x: np.ndarray) -> np.ndarray:
        return np.bincount(index, np.where(used, np.repeat(x, 3), 0.0), m)

    def slope(x: np.ndarray, target: np.ndarray) -> np.ndarray:
        left = take(x) - target
        left[0] = 0
        return left[index].reshape(n, 3).sum(1) + cost * x

    probe = np.ones(n)
    for _ in range(20):  # the largest eigenvalue gives the step
        probe = slope(probe, np.zeros(m))
        norm = float(np.linalg.norm(probe))
        probe /= norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * slope(y, histogram), 0)
        if float((y - new) @ (new - x)) > 0:
            t, y = 1.0, new  # the momentum points uphill
        else:
            t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            y = new + (was - 1) / t * (new - x)
        x = new
    return x


class Plan:
    """Runs (length, first number, sequences, pieces in each, first sequence, offset), and how many sequences there are."""

    def __init__(self, size: int):
        self.size, self.sequences = size, 0
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.taken: dict[int, int] = defaultdict(int)

    def put(self, length: int, sequences: int, each: int, first: int, offset: int) -> None:
        self.runs.append((length, self.taken[length], sequences, each, first, offset))
        self.taken[length] += sequences * each

    def repeat(self, parts: list[int], times: int) -> int:
        """`times` sequences of one pattern; the gap of each."""
        offset = 0
        for length in parts:
            self.put(length, times, 1, self.sequences, offset)
            offset += length
        self.sequences += times
        return self.size - offset

    def best_fit(self, left: np.ndarray, gaps: list[tuple[int, int, int]]) -> None:
        """Pieces by falling length into the smallest gaps that hold them; gaps: (gap, first sequence, sequences)."""
        gaps = sorted(gaps)
        for length in np.flatnonzero(left)[::-1].tolist():
            count = int(left[length])
            while count:
                at = bisect_left(gaps, (length,))
                if at < len(gaps):
                    gap, first, n = gaps.pop(at)
                else:
                    gap, first, n = self.size, self.sequences, -(-count // (self.size // length))
                    self.sequences += n
                each = gap // length
                full = min(n, count // each)
                some = min(count - full * each, each) if full < n else 0
                for sequences, pieces, start in ((full, each, first), (1, some, first + full)):
                    if sequences and pieces:
                        self.put(length, sequences, pieces, start, self.size - gap)
                        if gap > pieces * length:
                            insort(gaps, (gap - pieces * length, start, sequences))
                done = full + (some > 0)
                if done < n:
                    insort(gaps, (gap, first + done, n - done))
                count -= full * each + some

    def arrays(self) -> list[np.ndarray]:
        """Ordered keys (length and first number) and the other columns of the runs."""
        runs = np.array(sorted(self.runs), np.int64).reshape(-1, 6)
        return [(runs[:, 0] << NUMBER_BITS) | runs[:, 1], *runs.T[1:]]


def plan(histogram: np.ndarray, size: int, slack: int = 8, most: int = 100_000, rounds: int = 200) -> Plan:
    """The plan for histogram[length] pieces of each length up to `size`."""
    out, left = Plan(size), histogram.astype(np.int64).copy()
    left[0] = 0
    found = patterns(left, slack, most)
    x = fit(found, left.astype(float), rounds)
    gaps = []
    some = np.flatnonzero(x >= 0.5)
    for p in some[np.lexsort((some, found.waste[some], -x[some]))].tolist():
        parts = [v for v in found.parts[p].tolist() if v]
        times = min([int(x[p] + 0.5), *(int(left[v]) // parts.count(v) for v in parts)])
        if times:
            first = out.sequences
            gap = out.repeat(parts, times)
            for v in parts:
                left[v] -= times
            if gap:
                gaps.append((gap, first, times))
    out.best_fit(left, gaps)
    return out


def cut(docs: DataFrame, tokenizer: str, size: int, last: int, with_ids: bool) -> DataFrame:
    """One row for each piece, with its partition and its number among the partition's pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seen = WordTokens(tokenizer), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
        names = [c.split()[0] for c in PIECES.split(", ")]
        for given in batches:
            ids, text = given.column("doc_id").to_pylist(), given.column("text")
            for a, b in tv.pieces(text, CHUNK):
                got, bounds = tokens.texts(*tv.strings(text.slice(a, b - a)), last)
                rows = []
                for doc, low, high in zip(ids[a:b], bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    for piece, start in enumerate(range(low, high, size)):
                        raw = got[start : min(start + size, high)].tobytes()
                        length = len(raw) // 4
                        rows.append((doc, piece, start - low, length, zlib.crc32(raw), raw if with_ids else None, part, int(seen[length])))
                        seen[length] += 1
                del got
                tv.release()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def pack_by_patterns(docs: DataFrame, tokenizer: str, size: int = 4096, last: int = 1, slack: int = 8, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece (from 0), start, length, ids_crc32, sequence_id, offset, ids.

    A document's ids are those of its text and then `last`; one of more than `size` ids is
    cut into pieces of `size`, the last of which may be shorter. Sequences have the
    numbers from 0 on, without gaps, and pieces fill them from 0 on without gaps. ids
    (little-endian, unsigned 32 bits) are given with_ids only. Null and empty texts are the
    single id `last`; rows without a doc_id, or that repeat one, are documents of their
    own; an empty table gives an empty one; other columns are ignored. `tokenizer` is the
    path of a tokenizer that splits at white space, readable on every executor.
    """
    cuts = cut(docs, tokenizer, size, last, with_ids).checkpoint()  # read for the histogram, the numbers and the result
    by_part = cuts.groupBy("part", "length").count()
    histogram = np.zeros(size + 1, np.int64)
    for length, n in by_part.groupBy("length").agg(F.sum("count")).collect():  # one row for each length up to size
        histogram[length] = n
    keys, first, _, each, sequence, offset = plan(histogram, size, slack).arrays()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            length = given.column("length").to_numpy()
            number = given.column("nth").to_numpy() + given.column("before").to_numpy()
            run = np.searchsorted(keys, (length << NUMBER_BITS) | number, "right") - 1
            within = number - first[run]
            columns = {c: given.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            columns["sequence_id"] = pa.array(sequence[run] + within // each[run])
            columns["offset"] = pa.array(offset[run] + within % each[run] * length)
            names = [c.split()[0] for c in PLACED.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    before = by_part.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    return cuts.join(before, ["part", "length"]).mapInArrow(place, PLACED)
