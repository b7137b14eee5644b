"""Language identification by multilingual mixture inference.

Training counts character n-grams (1 to 3 characters, with the word's edges) for
each language in a fixed number of hash bins. A document is then a mixture: each
word has a likelihood under each language (the mean of its n-grams' log
likelihoods), and expectation-maximisation estimates the document's language
proportions. Sets of languages are compared by likelihood less a penalty for each
language more; the largest proportion of the chosen set is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

#: Bins of n-grams; the model has this many numbers for each language.
BINS = 1 << 16
#: Languages that a model may have, which bounds it (BINS x MOST_LANGUAGES floats).
MOST_LANGUAGES = 200


_LATIN = np.zeros(256, bool)
_LATIN[[*range(65, 91), *range(97, 123)]] = True


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of letters: a-z, and all of two bytes or more but U+0080 to U+00BF, U+2000 to U+2FFF and symbols."""
    ok = (data >= 97) & (data <= 122) | (data >= 0xC3)
    tail = (data & 0xC0) == 0x80
    lead = np.maximum.accumulate(np.where(tail, 0, np.arange(len(data)))) if len(data) else np.zeros(0, np.int64)
    first = data[lead] if len(data) else data
    after = data[np.minimum(lead + 1, len(data) - 1)] if len(data) else data
    bad = (first == 0xC2) | ((first == 0xE2) & (after < 0xB0)) | (first == 0xF0) & (after == 0x9F) | (first == 0xEF) & (after >= 0xB8)
    return np.where(tail, (first >= 0xC3), ok) & ~bad


class WordGrams:
    """Distinct letter-words of some rows, with the n-gram bins of each.

    Words are runs of letters. bins/of: one item for each n-gram, `of` its distinct
    word; inverse: the distinct word of every word; row: the row of every word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = tv.fold(data)
        solid = _letters(data)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.concatenate(([False], solid[:-1])), np.concatenate((solid[1:], [False]))
        start = np.flatnonzero(solid & (~before | edge[:-1])) if len(data) else np.zeros(0, np.int64)
        end = np.flatnonzero(solid & (~after | edge[1:])) + 1 if len(data) else start
        first = np.searchsorted(start, offsets)
        self.count = np.diff(first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)
        keys, index, self.inverse = np.unique(tv.HASH_A.ranges(data, start, end), return_index=True, return_inverse=True)
        start, end = start[index], end[index]
        self.n = len(keys)
        # the characters of the distinct words, an edge mark at both ends
        points = np.flatnonzero((data & 0xC0) != 0x80)
        stop = np.append(points[1:], len(data))
        char = tv.HASH_B.ranges(data, points, stop) if len(points) else np.zeros(0, np.uint64)
        a, b = np.searchsorted(points, start), np.searchsorted(points, end)
        size = b - a + 2
        base = np.concatenate(([0], np.cumsum(size)))
        seq = np.full(base[-1], 12345, np.uint64)
        inner = np.arange(int((b - a).sum())) + np.repeat(a - np.concatenate(([0], np.cumsum(b - a)[:-1])), b - a) if self.n else np.zeros(0, np.int64)
        place = np.ones(len(seq), bool)
        place[base[:-1]] = place[base[1:] - 1] = False
        seq[place] = char[inner]
        word = np.repeat(np.arange(self.n), size)
        bins, of = [], []
        for k in (1, 2, 3):
            h = tv.runs(seq, k)
            ok = word[: len(h)] == word[k - 1 :] if len(h) else np.zeros(0, bool)
            if k == 1:
                ok &= place[: len(h)]
            bins.append((h[ok] % np.uint64(BINS)).astype(np.int64))
            of.append(word[: len(h)][ok])
        self.bins, self.of = np.concatenate(bins), np.concatenate(of)


@dataclass(frozen=True)
class Model:
    """languages in code-point order; log: BINS x languages, the log likelihood of each n-gram bin."""

    languages: tuple[str, ...]
    log: np.ndarray


def fit(labelled: DataFrame) -> Model:
    """A model from labelled(text, lang); rows with a null lang are left out.

    Counts are summed for each partition, then for each language and bin; what the
    driver gets is bounded by BINS x MOST_LANGUAGES. More languages raise an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            text, langs = batch.column("text"), np.array(batch.column("lang").to_pylist(), object)
            for a, b in tv.pieces(text):
                g = WordGrams(*tv.strings(text.slice(a, b - a)))
                for lang in set(langs[a:b]):
                    mine = np.bincount(g.inverse[langs[a:b][g.row] == lang], minlength=g.n)
                    sums[lang] = sums.get(lang, 0) + np.bincount(g.bins, weights=mine[g.of], minlength=BINS)
        for lang, v in sums.items():
            k = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k, pa.int32()), pa.array(v[k].astype(np.int64))], names=["lang", "bin", "n"])

    rows = labelled.filter("lang IS NOT NULL").select("text", "lang").mapInArrow(run, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).checkpoint()
    languages = sorted(r.lang for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((BINS, len(languages)))
    table = rows.toArrow()
    place = {lang: i for i, lang in enumerate(languages)}
    counts[table["bin"].to_numpy(), [place[x] for x in table["lang"].to_pylist()]] = table["n"].to_numpy()
    share = (counts + 0.5) / (counts.sum(0) + 0.5 * BINS)
    return Model(tuple(languages), np.log(share).astype(np.float32))


def mixtures(like: np.ndarray, row: np.ndarray, n_rows: int, allowed: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log likelihood) of each row by expectation-maximisation.

    like: words x languages; row: of each word, ascending; allowed: rows x languages.
    """
    share = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    at = np.flatnonzero(np.diff(row, prepend=-1))
    some = row[at]
    n = np.maximum(np.bincount(row, minlength=n_rows), 1)[:, None]
    total = np.zeros(n_rows)
    for step in range(rounds):
        joint = like * share[row]
        sums = np.maximum(joint.sum(1, keepdims=True), 1e-300)
        if step == rounds - 1:
            total[some] = np.add.reduceat(np.log(sums[:, 0]), at) if len(at) else 0
            break
        new = np.zeros_like(share)
        if len(at):
            new[some] = np.add.reduceat(joint / sums, at, axis=0)
        share = new / n
    return share, total


def infer(model: Model, data: np.ndarray, offsets: np.ndarray, penalty: float = 3.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number or -1, proportion, proportions) of each row.

    Languages enter greedily, the one with the largest proportion first; a set with one
    language more must gain `penalty` in log likelihood. The score is the prediction's
    share of the chosen set's mixture.
    """
    n_rows, n_langs = len(offsets) - 1, len(model.languages)
    g = WordGrams(data, offsets)
    like = np.zeros((g.n, n_langs))
    if g.n:
        at = np.flatnonzero(np.diff(g.of[order := np.argsort(g.of, kind="stable")], prepend=-1))
        log = np.add.reduceat(model.log[g.bins[order]].astype(float), at, axis=0)
        log /= np.bincount(g.of, minlength=g.n)[:, None] / 2  # n-grams overlap: a word counts as two of them
        like = np.exp(log - log.max(1, keepdims=True))
    like = like[g.inverse]
    share, _ = mixtures(like, g.row, n_rows, np.ones((n_rows, n_langs)))
    rank = np.argsort(-share, axis=1, kind="stable")
    best = np.zeros((n_rows, n_langs))
    best[np.arange(n_rows), rank[:, 0]] = 1
    chosen, value = mixtures(like, g.row, n_rows, best, rounds=2)
    growing = np.ones(n_rows, bool)
    for k in range(1, n_langs):
        more = best.copy()
        more[np.arange(n_rows)[growing], rank[growing, k]] = 1
        rows = np.flatnonzero(growing & (share[np.arange(n_rows), rank[:, k]] > 0.02))
        if not len(rows):
            break
        pick = np.isin(g.row, rows)
        local = np.searchsorted(rows, g.row[pick])
        s, v = mixtures(like[pick], local, len(rows), more[rows])
        better = v > value[rows] + penalty
        growing[:] = False
        hit = rows[better]
        growing[hit], best[hit], chosen[hit], value[hit] = True, more[hit], s[better], v[better]
    lang = np.where(g.count > 0, chosen.argmax(1), -1)
    plain = np.concatenate(([0], np.cumsum(_LATIN[data])))
    raw = data.tobytes()
    for i in np.flatnonzero(np.diff(plain[offsets]) == 0):  # no a-z: what counts as a letter is Unicode's say
        letters = any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].decode())
        lang[i] = (chosen[i].argmax() if letters else -1)
    return lang, np.where(lang >= 0, chosen.max(1), 0.0), chosen


def identify(docs: DataFrame, model: Model, penalty: float = 3.0) -> DataFrame:
    """doc_id, lang_pred, score, languages (those of the chosen set with their shares, largest first).

    `und`, 0 and an empty list for a null or empty text, one without a letter, and any
    text if the model has no language. Rows are judged alone, so repeated doc_ids do no
    harm; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            text = batch.column("text")
            for a, b in tv.pieces(text, max(1, tv.CHUNK_BYTES * 8 // max(8, len(model.languages)))):
                data, offsets = tv.strings(text.slice(a, b - a))
                if model.languages:
                    lang, score, share = infer(model, data, offsets, penalty)
                else:
                    lang, score, share = np.full(b - a, -1), np.zeros(b - a), np.zeros((b - a, 0))
                order = np.argsort(-share, axis=1, kind="stable")
                sets = [[(names[j], float(share[i, j])) for j in order[i] if share[i, j] > 0] if lang[i] >= 0 else [] for i in range(b - a)]
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(names[lang], pa.string()), pa.array(np.clip(score, 0, 1)), pa.array([[dict(zip(("lang", "share"), p, strict=True)) for p in x] for x in sets], kind)], names=["doc_id", "lang_pred", "score", "languages"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, languages array<struct<lang: string, share: double>>")
