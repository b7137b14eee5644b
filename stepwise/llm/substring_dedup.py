"""Substring deduplication by automata of recurring phrases.

Words covered by a window of `window` words that also starts earlier are removed.

1. Anchors. Each window names the smallest hash among its word 6-grams, so equal
   windows name equal anchors. Blocks send their distinct anchors to shards, which
   confirm those that occur at two places or more.
2. Phrases. Consecutive windows that share a confirmed anchor are one phrase. Blocks
   send the words of each distinct phrase once, to the anchor's shard. An anchor that
   very many blocks hold is too much for one shard: its windows go one by one, each to
   the shard of its own hash.
3. Confirmation. A shard compares the windows of all phrases word by word and finds
   where each starts first. The phrases in which some window recurs are confirmed
   passages; each block that holds one gets its words, and where its windows start first.
4. Automata. Each block compiles the passages that it got into Aho-Corasick automata of
   bounded size and streams its documents through them to locate every occurrence;
   windows that start later than their first start cover what goes.

An automaton's alphabet is the words of its passages: each word is one code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import textvec as tv
from .blocks import BLOCK_BYTES, SHARD_BYTES, answer, by_shard, counts, doc_ids, in_blocks, kept_strings, padded, text_bytes, text_chunks, unpack

#: Words of an anchor, and windows of a phrase at most.
GRAM, LONGEST = 6, 256
#: Passages and words in one automaton, which bounds its memory (code points end at 1.1 million).
PHRASES, LETTERS = 10_000, 300_000
#: Shards of phrases for each shard of anchors, as phrases overlap and take more room than the text.
PHRASE_SHARDS = 8
#: Occurrences handled at once.
HITS = 1 << 13
#: Blocks that hold an anchor from which on its windows go one by one.
HOT = 512

ANCHORS = "shard int, block int, anchors binary, many binary"
CONFIRMED = "block int, anchors binary, hot binary"
PHRASE_ROWS = "shard int, block int, phrases array<string>, docs binary, starts binary, again binary"
FIRSTS = "block int, phrases array<string>, runs binary, sizes binary, docs binary, shifts binary"


class Windows:
    """All windows of a chunk of rows, their hashes and anchors."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.words = tv.Words(data, offsets)
        self.word_hash = self.words.hashes()
        row = self.words.row
        n = max(0, len(row) - window + 1)
        self.start = np.flatnonzero(row[:n] == row[window - 1 :][:n]) if n else np.zeros(0, np.int64)
        self.hash = tv.runs(self.word_hash, window)[self.start]
        self.grams = tv.runs(self.word_hash, GRAM)
        self.span = window - GRAM + 1
        self.anchor = tv.sliding_min(self.grams, self.span)[self.start] if len(self.start) else np.zeros(0, np.uint64)

    def anchor_places(self) -> np.ndarray:
        """The anchors, once for each place at which they stand."""
        chosen = np.zeros(len(self.grams), bool)
        for shift in range(self.span):
            at = self.start + shift
            chosen[at[self.grams[at] == self.anchor]] = True
        return self.grams[chosen]

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """(first window, number of windows) of each run with one anchor in one row."""
        if not len(self.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.ones(len(self.start), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (np.diff(self.start) != 1)
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(self.start)))
        if len(size) and size.max() > LONGEST:
            parts = -(-size // LONGEST)
            at = np.repeat(at, parts) + LONGEST * _spread(np.zeros(len(at), np.int64), parts)
            size = np.diff(np.append(at, len(self.start)))
        return at, size


def _spread(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indexes at[i] .. at[i]+size[i]-1."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at - (ends - size), size)


def _columns(rows: list[tuple], schema: str) -> pa.Table:
    types = {"int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table([pa.concat_arrays(c) if c and isinstance(c[0], pa.Array) else pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _one_list(items: pa.Array) -> pa.Array:
    """An array of one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items)


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("doc_id")


def _send_anchors(n_shards: int, window: int):
    def send(table: pa.Table) -> pa.Table:
        got, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, _, data, offsets in text_chunks(table.select(["text"])):
            places = Windows(data, offsets, window).anchor_places()
            more, times = np.unique(places, return_counts=True)
            both, inverse = np.unique(np.concatenate((got, more)), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate((n, times)), minlength=len(both)).astype(np.int64)
            got = both
        many = (n > 1).astype(np.uint8)
        block = table["block"][0].as_py()
        return _columns([(s, block, got[i].tobytes(), many[i].tobytes()) for s, i in by_shard(got, n_shards)], ANCHORS)

    return send


def _confirm(most: int):
    """The anchors that stand at two places or more, and whether more than `most` blocks hold them."""

    def confirm(table: pa.Table) -> pa.Table:
        anchors, sizes = unpack(table["anchors"], np.uint64)
        many, _ = unpack(table["many"], np.uint8)
        _, inverse, n = np.unique(anchors, return_inverse=True, return_counts=True)
        often = (n > 1) | (np.bincount(inverse, weights=many, minlength=len(n)) > 0)
        good, hot = often[inverse], (n > most)[inverse].astype(np.uint8)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        rows = []
        for block, a, b in zip(table["block"].to_pylist(), bounds[:-1], bounds[1:], strict=True):
            mine = anchors[a:b][good[a:b]]
            if len(mine):
                rows.append((block, mine.tobytes(), hot[a:b][good[a:b]].tobytes()))
        return _columns(rows, CONFIRMED)

    return confirm


def _phrase_texts(words: tv.Words, at: np.ndarray, length: np.ndarray) -> pa.Array:
    """The words from `at`, `length` of them, joined by one space, as one string each."""
    word = _spread(at, length)
    size = words.end[word] - words.start[word] + 1  # with a space
    out = np.full(int(size.sum()), 32, np.uint8)
    ends = np.cumsum(size)
    hold = np.ones(len(out), bool)
    hold[ends - 1] = False
    out[hold] = words.data[_spread(words.start[word], size - 1)]
    last = ends[np.cumsum(length) - 1] if len(length) else ends
    hold = np.ones(len(out), bool)
    hold[last - 1] = False
    bounds = np.concatenate(([0], last - np.arange(1, len(last) + 1)))
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(out[hold].tobytes())]).cast(pa.string())


def _send_phrases(n_shards: int, window: int):
    def send(table: pa.Table, confirmed: pa.Table) -> pa.Table:
        if not table.num_rows or not confirmed.num_rows:
            return _columns([], PHRASE_ROWS)
        good, hot = unpack(confirmed["anchors"], np.uint64)[0], unpack(confirmed["hot"], np.uint8)[0]
        order = np.argsort(good)
        good, hot = good[order], hot[order]
        table = _sorted(table)
        ids = doc_ids(table)
        parts: list[tuple] = []
        for a, b, data, offsets in text_chunks(table.select(["text"])):
            w = Windows(data, offsets, window)
            at, size = w.phrases()
            if not len(at):
                continue
            near = np.minimum(np.searchsorted(good, w.anchor[at]), len(good) - 1)
            keep = good[near] == w.anchor[at]
            at, size, single = at[keep], size[keep], hot[near[keep]] > 0
            one = _spread(at[single], size[single])
            key = np.concatenate((w.anchor[at[~single]], w.hash[one]))
            at, size = np.concatenate((at[~single], one)), np.concatenate((size[~single], np.ones(len(one), np.int64)))
            if not len(at):
                continue
            order = np.lexsort((size, at))
            at, size, key = at[order], size[order], key[order]
            first = w.start[at]
            row = w.words.row[first]
            text = _phrase_texts(w.words, first, size + window - 1)
            text = text.dictionary_encode()  # equal words, equal phrase; the first is the earliest, as rows go by doc_id, then start
            code = text.indices.to_numpy()
            index = np.unique(code, return_index=True)[1]
            times = np.bincount(code)
            parts.append((text.dictionary, key[index], ids[a:b][row[index]], (first - w.words.first[row])[index], times > 1))
        if not parts:
            return _columns([], PHRASE_ROWS)
        texts = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
        key, doc, start, again = (np.concatenate(x) for x in list(zip(*parts, strict=True))[1:])
        code = texts.indices.to_numpy()
        index = np.unique(code, return_index=True)[1]
        again = (np.bincount(code, weights=again + 1.0) > 1).astype(np.uint8)
        block = table["block"][0].as_py()
        rows = []
        for s, i in by_shard(key[index], n_shards):
            j = index[i]
            rows.append((pa.array([s], pa.int32()), pa.array([block], pa.int32()), _one_list(texts.dictionary.take(pa.array(i))), *(pa.array([x.tobytes()], pa.binary()) for x in (doc[j], start[j].astype(np.int32), again[i]))))
        return _columns(rows, PHRASE_ROWS)

    return send


def _first_starts(window: int):
    """For each phrase sent, where its windows start first; phrases of windows that occur once are left out."""

    def first_starts(table: pa.Table) -> pa.Table:
        lists = table["phrases"].combine_chunks()
        n = pc.list_value_length(lists).to_numpy()
        texts = lists.flatten()
        doc, start, again = unpack(table["docs"], np.int64)[0], unpack(table["starts"], np.int32)[0].astype(np.int64), unpack(table["again"], np.uint8)[0]
        distinct = texts.dictionary_encode()
        of_text = distinct.indices.to_numpy()
        got, done = [], 0
        for a, b in tv.pieces(distinct.dictionary):
            w = Windows(*tv.strings(distinct.dictionary.slice(a, b - a)), window)
            got.append((w.hash, w.anchor, w.start + done, w.word_hash, w.words.count - window + 1))
            done += len(w.word_hash)
            del w
        hashes, anchor, at, word_hash, count = (np.concatenate(x) for x in zip(*got, strict=True))  # count: windows of each distinct text
        base_of = np.concatenate(([0], np.cumsum(count)[:-1])).astype(np.int64)
        # windows of distinct texts get one number each; hashes propose, the words decide
        order = np.lexsort((anchor, hashes))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
        before = np.concatenate((order[:1], order[:-1]))
        for k in range(window):
            new |= word_hash[at[order] + k] != word_hash[at[before] + k]
        name = np.empty(len(order), np.int64)
        name[order] = np.cumsum(new) - 1
        # every phrase sent has all windows of its text
        size = count[of_text]
        of = np.repeat(np.arange(len(of_text)), size)
        base = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
        inside = np.arange(len(of)) - base[of]
        windows = name[base_of[of_text][of] + inside]
        place = start[of] + inside
        order = np.lexsort((place, doc[of], windows))
        new = np.ones(len(order), bool)
        new[1:] = windows[order][1:] != windows[order][:-1]
        group = np.cumsum(new) - 1
        lead = order[np.flatnonzero(new)]
        twice = np.bincount(group, minlength=1) > 1
        first_doc, shift, recurs = np.empty(len(of), np.int64), np.empty(len(of), np.int32), np.empty(len(of), bool)
        first_doc[order], shift[order], recurs[order] = doc[of][lead][group], place[lead][group] - inside[order], twice[group]
        needed = (np.maximum.reduceat(recurs, base) | (again > 0)) if len(base) else np.zeros(0, bool)
        run = np.ones(len(of), bool)  # windows that follow each other in one earlier place are one run
        run[1:] = (of[1:] != of[:-1]) | (first_doc[1:] != first_doc[:-1]) | (shift[1:] != shift[:-1])
        bounds = np.concatenate(([0], np.cumsum(n)))
        rows = []
        for block, a, b in zip(table["block"].to_pylist(), bounds[:-1], bounds[1:], strict=True):
            j = a + np.flatnonzero(needed[a:b])
            if len(j):
                i = _spread(base[j], size[j])
                heads = i[run[i]]
                ends = np.append(np.flatnonzero(run[i]), len(i))
                runs = np.bincount(np.searchsorted(j, of[heads]), minlength=len(j)).astype(np.int32)
                rows.append((pa.array([block], pa.int32()), _one_list(texts.take(pa.array(j))), *(pa.array([x.tobytes()], pa.binary()) for x in (runs, np.diff(ends).astype(np.int32), first_doc[heads], shift[heads]))))
        return _columns(rows, FIRSTS)

    return first_starts


def _letters(index: np.ndarray) -> str:
    """Numbers from 0 as code points from 2, past the surrogates."""
    code = (index + 2).astype(np.uint32)
    code[code >= 0xD800] += 0x800
    return code.tobytes().decode("utf-32-le")


class Automaton:
    """Passages compiled over an alphabet of their words."""

    def __init__(self, word_hash: np.ndarray, at: np.ndarray, length: np.ndarray):
        self.alphabet = np.unique(word_hash[_spread(at, length)])
        self.length = length
        stream = _letters(np.searchsorted(self.alphabet, word_hash[_spread(at, length)]))
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        ends = np.cumsum(length)
        for k, (a, b) in enumerate(zip((ends - length).tolist(), ends.tolist(), strict=True)):
            self.machine.add_word(stream[a:b], k)
        self.machine.make_automaton()

    def locate(self, word_hash: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Every (first word, passage) where the words of a passage occur in one row of words, HITS at a time: in a long run of one word very many passages overlap."""
        code = np.minimum(np.searchsorted(self.alphabet, word_hash), len(self.alphabet) - 1)
        text = np.where(self.alphabet[code] == word_hash, code, -1)  # -1: a word of no passage
        rows = np.flatnonzero(np.diff(row, prepend=-1))
        text = np.insert(text, rows, -1)  # no match runs from one row into the next
        found = self.machine.iter(_letters(text))
        while some := list(islice(found, HITS)):
            hits = np.array(some, np.int64).reshape(-1, 2)
            first = hits[:, 0] + 1 - self.length[hits[:, 1]]
            yield first - np.searchsorted(rows + np.arange(len(rows)), first, "right"), hits[:, 1]


class Passages:
    """The confirmed passages that a block got: their automata, and the first starts of their windows."""

    def __init__(self, firsts: pa.Table, window: int):
        lists = firsts["phrases"].combine_chunks()
        words = tv.Words(*tv.strings(lists.flatten() if len(lists) else pa.array([], pa.string())))
        word_hash = words.hashes()
        runs, size = unpack(firsts["runs"], np.int32)[0], unpack(firsts["sizes"], np.int32)[0].astype(np.int64)
        of = np.repeat(np.arange(len(runs)), runs)
        self.doc = np.repeat(unpack(firsts["docs"], np.int64)[0], size)
        self.shift = np.repeat(unpack(firsts["shifts"], np.int32)[0].astype(np.int64), size)
        self.size = np.bincount(of, weights=size, minlength=len(runs)).astype(np.int64)
        self.base = np.concatenate(([0], np.cumsum(self.size)[:-1])).astype(np.int64)
        self.word_hash, self.first, self.length = word_hash, words.first, self.size + window - 1

    def automata(self):
        """(number of the first passage, automaton) one after the other."""
        a, total = 0, np.concatenate(([0], np.cumsum(self.length)))
        while a < len(self.length):
            b = max(a + 1, min(a + PHRASES, int(np.searchsorted(total, total[a] + LETTERS, "right")) - 1))
            yield a, Automaton(self.word_hash, self.first[a:b], self.length[a:b])
            a = b


def _remove(window: int):
    def remove(table: pa.Table, firsts: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "removed": pa.array([], pa.list_(pa.int32()))})
        passages = Passages(firsts, window)
        table = _sorted(table)
        ids = doc_ids(table)
        chunks = [(a, b, tv.Words(data, offsets), offsets) for a, b, data, offsets in text_chunks(table.select(["text"]))]
        hashes = [words.hashes() for _, _, words, _ in chunks]
        covers = [np.zeros(len(words.start) + 1, np.int32) for _, _, words, _ in chunks]
        for base, machine in passages.automata():
            for (a, b, words, _), word_hash, covered in zip(chunks, hashes, covers, strict=True):
                later = np.zeros(len(covered), bool)
                for first, k in machine.locate(word_hash, words.row):
                    k = k + base
                    count = passages.size[k]
                    step = _spread(np.zeros(len(k), np.int64), count)
                    i = _spread(passages.base[k], count)
                    word = np.repeat(first, count) + step
                    row = words.row[word]
                    start, owner = word - words.first[row], ids[a:b][row]
                    later[word[(owner > passages.doc[i]) | ((owner == passages.doc[i]) & (start > passages.shift[i] + step))]] = True
                at = np.flatnonzero(later)
                covered[at] += 1
                covered[at + window] -= 1
        texts, n_words, n_removed, spans = [], [], [], []
        for (a, b, words, offsets), covered in zip(chunks, covers, strict=True):
            gone = np.cumsum(covered[:-1]) > 0
            padded_data, padded_offsets = padded(words.data, offsets, 32)
            change = np.zeros(len(padded_data) + 1, np.int8)
            moved = words.row[~gone]
            change[words.start[~gone] + moved] += 1
            np.subtract.at(change, words.end[~gone] + moved + 1, 1)
            padded_data = padded_data.copy()
            padded_data[tv._WS[padded_data]] = 32
            texts.append(kept_strings(padded_data, padded_offsets, np.cumsum(change[:-1], dtype=np.int8) > 0))
            n_words.append(words.count)
            n_removed.append(np.bincount(words.row[gone], minlength=b - a))
            spans.append(_spans(gone, words, b - a))
        join = lambda x: pa.array(np.concatenate(x), pa.int64())
        tv.release()
        return pa.table({"doc_id": table["doc_id"], "text": pa.chunked_array(texts, pa.string()), "n_words": join(n_words), "n_removed": join(n_removed), "removed": pa.chunked_array(spans)})

    return remove


def _spans(gone: np.ndarray, words: tv.Words, n_rows: int) -> pa.Array:
    """Removed ranges of each row, as word numbers from, to, from, to, ..."""
    edge = gone & np.concatenate(([True], ~gone[:-1] | (words.row[1:] != words.row[:-1]))) if len(gone) else gone
    stop = gone & np.concatenate((~gone[1:] | (words.row[1:] != words.row[:-1]), [True])) if len(gone) else gone
    a, b = np.flatnonzero(edge), np.flatnonzero(stop)
    row = words.row[a]
    flat = np.empty(2 * len(a), np.int32)
    flat[0::2], flat[1::2] = a - words.first[row], b + 1 - words.first[row]
    bounds = np.concatenate(([0], np.cumsum(2 * np.bincount(row, minlength=n_rows)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def drop_repeated_phrases(docs: DataFrame, window: int = 20, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, text (kept words joined by one space), n_words, n_removed, removed (word ranges: from, to, from, to, ...).

    Words are runs without ASCII white space. A word goes if a window over it has the
    same words as a window that starts in a smaller doc_id, or earlier in the same
    document; windows are judged on the input. Null and empty texts have no words and
    give an empty text; rows that share a doc_id are judged by it and their own word
    numbers (of equal starts, all stay), and so are all rows without a doc_id, which
    comes after all others; an empty table gives an empty one; other columns are ignored.
    """
    if window < GRAM:
        raise ValueError(f"window must be at least {GRAM}")
    n_blocks, n_shards = counts(text_bytes(docs), block_bytes, shard_bytes)
    blocks = in_blocks(docs, n_blocks, "doc_id", "text")
    anchors = blocks.groupBy("block").applyInArrow(_send_anchors(n_shards, window), ANCHORS)
    confirmed = anchors.groupBy("shard").applyInArrow(_confirm(hot), CONFIRMED)
    phrases = answer(blocks, confirmed, _send_phrases(n_shards * PHRASE_SHARDS, window), PHRASE_ROWS)
    firsts = phrases.groupBy("shard").applyInArrow(_first_starts(window), FIRSTS)
    return answer(blocks, firsts, _remove(window), "doc_id long, text string, n_words long, n_removed long, removed array<int>")
