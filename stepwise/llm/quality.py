"""Quality classifier: a regularised quadratic discriminant over document statistics.

Every text gives the same fixed statistics, transformed to be nearer to normal. They
are measured where the text is read, so that labels meet short vectors and not texts.
One distributed pass sums each class's count, mean and second moments; the model is
one mean and one shrunken covariance for each class, small whatever the input. A score is
the difference of the two log densities (Mahalanobis distances by cached Cholesky
factors), squashed to 0..1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

FEATURES = ["word_length", "upper", "digit", "mark", "pipe", "symbol", "high", "distinct", "top_word", "log_line", "line_repeats", "phrase_repeats", "short_words", "capital_words", "stops", "stray", "stutter"]

#: Words (lines, shingles) added to every denominator, so that shares of short texts stay near those of long ones.
EASE = 20

_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91)]] = 1
_KIND[[*range(97, 123)]] = 2
_KIND[[*range(48, 58)]] = 3
_KIND[[ord(c) for c in ".,;:'\"()?-"]] = 4
_KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_KIND[128:] = 6


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x FEATURES; an empty text gives zeros."""
    n = len(offsets) - 1
    words = tv.Words(data, offsets)
    size, count = np.diff(offsets).astype(float), words.count.astype(float)
    kind = _KIND[data]

    def per_row(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask)))
        return np.diff(sums[offsets]).astype(float)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(words.row, weights=mask, minlength=n)

    some, per = size + 5 * EASE, count + EASE
    letters = per_row((kind == 1) | (kind == 2)) + 5 * EASE
    length = words.end - words.start
    h = words.hashes()
    row, value = words.row, h
    stutter = np.zeros(len(h), bool)
    stutter[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((value, row))
    new = np.ones(len(order), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (value[order][1:] != value[order][:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(order)))
    distinct = np.bincount(row[order][at], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, row[order][at], times)
    five_row, _ = tv.unique_pairs(*(shingled := tv.shingles(words, 5)))
    fives, distinct_fives = np.bincount(shingled[0], minlength=n), np.bincount(five_row, minlength=n)
    feeds = per_row(data == 10) + 1
    edge = np.union1d(offsets[:-1], np.flatnonzero(data == 10) + 1)
    edge = edge[edge < len(data)]
    line_row = np.searchsorted(offsets, edge, "right") - 1
    stop = np.minimum(np.append(edge[1:], len(data)), offsets[line_row + 1])
    line_hash = tv.HASH_A.ranges(data, edge, stop)
    lines, distinct_lines = np.bincount(line_row, minlength=n), np.bincount(tv.unique_pairs(line_row, line_hash)[0], minlength=n)
    first, last = (kind[words.start], kind[words.end - 1]) if len(h) else (np.zeros(0), np.zeros(0))
    share = lambda x: np.arcsin(np.sqrt(np.clip(x, 0, 1)))
    out = np.stack(
        [
            np.log1p((of_words(length) + 5 * EASE) / (count + EASE)), share(per_row(kind == 1) / letters), share(per_row(kind == 3) / some),
            share(per_row(kind == 4) / some), share(per_row(data == 124) / some), share(per_row(kind == 5) / some), share(per_row(kind == 6) / some),
            share((count - distinct) / per), share(top / per), np.log1p((size + 50 * EASE) / (feeds + EASE)), share((lines - distinct_lines) / (lines + EASE)), share((fives - distinct_fives) / (fives + EASE)),
            share(of_words(length <= 3) / per), share(of_words(first == 1) / per), share(of_words(last == 4) / per), share(of_words(last == 5) / per), share(of_words(stutter) / per),
        ],
        1,
    )
    out[count == 0] = 0
    return out


@dataclass(frozen=True)
class Model:
    """Classes 0 and 1: log prior and mean; the inverse of the Cholesky factor and half the log determinant of the covariance."""

    prior: np.ndarray
    mean: np.ndarray
    whiten: np.ndarray
    half_log_det: np.ndarray
    temper: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1; `temper` scales the log-density difference by the number of statistics, as they aren't independent."""
        log = [self.prior[c] - self.half_log_det[c] - 0.5 * (((x - self.mean[c]) @ self.whiten[c].T) ** 2).sum(1) for c in (0, 1)]
        return 1 / (1 + np.exp(-np.clip((log[1] - log[0]) * self.temper, -50, 50)))


def model_of(n: np.ndarray, total: np.ndarray, outer: np.ndarray, pooled: float = 0.3, spherical: float = 0.05, temper: float = 0.25) -> Model:
    """From each class's count, sum and sum of outer products. Classes without rows take the mean and spread of all rows."""
    d = total.shape[1]
    everything = max(n.sum(), 1)
    mean_all = total.sum(0) / everything
    mean = np.stack([total[c] / n[c] if n[c] else mean_all for c in (0, 1)])
    within = sum(outer[c] - n[c] * np.outer(mean[c], mean[c]) for c in (0, 1)) / everything
    whiten, half = [], []
    for c in (0, 1):
        own = outer[c] / n[c] - np.outer(mean[c], mean[c]) if n[c] else within
        s = (1 - pooled) * own + pooled * within
        spread = np.diag(np.diag(within)) + np.eye(d) * 1e-4
        factor = np.linalg.cholesky((1 - spherical) * s + spherical * spread + np.eye(d) * 1e-6)
        whiten.append(np.linalg.inv(factor))
        half.append(np.log(np.diag(factor)).sum())
    prior = np.log((n + 1) / (n.sum() + 2))
    return Model(prior, mean, np.stack(whiten), np.array(half), temper)


def _parts(table: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    text = table.column("text")
    for a, b in tv.pieces(text):
        yield a, b, statistics(*tv.strings(text.slice(a, b - a)))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and statistics (len(FEATURES) doubles as binary) of each row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x in _parts(batch):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "statistics"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, statistics binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(-1, len(FEATURES))


def fit(labelled: DataFrame) -> Model:
    """A model from labelled(statistics, label): label 1 or 0; other labels and null are left out.

    Each partition sums its classes' moments, so only a small matrix for each
    partition is added up. No labelled rows: every score is 0.5.
    """
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label, x = batch.column("label").to_numpy(), _matrix(batch.column("statistics"))
            for c in (0, 1):
                mine = x[label == c]
                sums[c] += np.concatenate(([len(mine)], mine.sum(0), (mine.T @ mine).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size), pa.int32()), pa.array(sums.ravel())], names=["k", "v"])

    rows = labelled.filter("label IN (0, 1)").select("statistics", F.col("label").cast("int").alias("label")).mapInArrow(run, "k int, v double")
    sums = np.zeros(2 * (1 + d + d * d))
    for k, v in rows.groupBy("k").agg(F.sum("v")).collect():  # 2 x (1 + d + d^2) numbers
        sums[k] = v
    sums = sums.reshape(2, -1)
    return model_of(sums[:, 0], sums[:, 1 : 1 + d], sums[:, 1 + d :].reshape(2, d, d))


def scored(statistics_: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1; higher: class 1 likelier) and predicted (1 if score >= 0.5, else 0) of measured() rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column("statistics")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return statistics_.select("doc_id", "statistics").mapInArrow(run, f"doc_id {statistics_.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and predicted, as scored() gives them.

    A null text counts as empty, which is scored as any text is. All other columns
    are passed on unread; of the input's own score and predicted columns none remains.
    """
    kept = docs.drop("score", "predicted")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.score(s) for _, _, s in _parts(batch)]
            score = np.concatenate(x) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return kept.mapInArrow(run, f"{fields}, score double, predicted int")


def bucket(column: Column, n: int) -> Column:
    """crc32 of the column as text, modulo n."""
    return F.crc32(column.cast("string").cast("binary")) % n


def quality_model(statistics_: DataFrame, labels: DataFrame) -> Model:
    """The model from measured() rows with a label that aren't held out (crc32(doc_id) mod 3 is not 1)."""
    known = labels.filter(F.col("quality").isin(0, 1) & (bucket(F.col("doc_id"), 3) != 1)).select("doc_id", F.col("quality").alias("label"))
    return fit(statistics_.join(known, "doc_id"))
