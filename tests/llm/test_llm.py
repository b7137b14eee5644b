"""The ten operators: brute force, round trips, held-out accuracy, and odd rows."""

import collections
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepwise.llm import blocks, chat, embedding_dedup, fingerprints, langid, line_dedup, mixing, near_dedup, packing, quality, queries, substring_dedup
from stepwise.llm import textvec as tv
from stepwise.llm.components import components
from stepwise.llm.embedding_dedup import near_vectors

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     *(T.StructField(c, T.StringType()) for c in ("block", "score", "copies", "component", "tree", "key", "tail", "part"))])


def odd_texts():
    rng = random.Random(5)
    base = " ".join(f"w{rng.randint(0, 400)}" for _ in range(300))
    words = base.split()
    edited = [" ".join(w if rng.random() > 0.02 else "x" for w in words) for _ in range(6)]
    other = " ".join(f"v{rng.randint(0, 400)}" for _ in range(80))
    lines = "First line of text\nSecond, longer line\nshort\n\n  FIRST line OF text \n"
    return [None, "", " \n\t ", "one", "One two", "one two three four five", base, base, base, *edited, other + " " + " ".join(words[40:90]), other, "a b " * 60, "a b " * 60 + "c", lines, lines.upper(), "Zwölf Köche\r\nfür «die» Königin…", "日本語 テキスト です", "é" * 5000, "x " * 40_000, "!!! ??? ...", base.upper(), "\x00 \x01 nul"]


@pytest.fixture(scope="module")
def odd(spark):
    texts = odd_texts()
    rows = [(i, t, None if i % 5 == 0 else ("en", "de")[i % 2], None if i % 4 == 0 else f"s{i % 3}", None, *["clash"] * 8) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


# text helpers


def test_words_and_hashes_match_python():
    texts = odd_texts()
    words = tv.Words(*tv.strings(pa.array(texts, pa.string())))
    flat = [w for t in texts for w in WORD.findall(t or "")]
    assert words.count.tolist() == [len(WORD.findall(t or "")) for t in texts]
    h = words.hashes()
    by_word = dict(zip(flat, h.tolist(), strict=True))
    assert [by_word[w] for w in flat] == h.tolist() and len(set(by_word.values())) == len(by_word)


def test_sliced_and_chunked_columns():
    column = pa.chunked_array([["ab", None], ["", "c d"]])
    data, offsets = tv.strings(column)
    assert (bytes(data), offsets.tolist()) == (b"abc d", [0, 2, 2, 2, 5])
    data, offsets = tv.strings(pa.array(["xx", "ab", "c"]).slice(1))
    assert (bytes(data), offsets.tolist()) == (b"abc", [0, 2, 3])


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30) if i != 11] + [(100, 90), (95, 90), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 if i <= 11 else 12 for i in range(31)}, 90: 90, 95: 90, 100: 90}


# 1 packing


def check_packing(rows, docs, size=4096):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    ids = {k: [*t.encode(v or "", add_special_tokens=False).ids, 2] for k, v in docs.items()}
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert by_doc.keys() == ids.keys()
    for k, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = ids[k][r.start : r.start + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids[k]), zlib.crc32(np.array(part, "<u4").tobytes())) and r.length > 0
            at += r.length
        assert at == len(ids[k])
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and pieces[0].padded_length == (at if at & (at - 1) == 0 else size)
        padding += pieces[0].padded_length - at
    return padding, sum(map(len, ids.values()))


def test_packing(odd, none):
    rows = packing.pack(odd, queries.tokenizer_path()).collect()
    check_packing(rows, texts_of(odd))
    assert packing.pack(none, queries.tokenizer_path()).isEmpty()


def test_packing_pads_little(spark, sf):
    rows = queries.op1_packing(spark, sf).collect()
    padding, total = check_packing(rows, texts_of(spark.read.parquet(f"{sf}/documents.parquet")))
    assert padding < 0.01 * total


def test_words_are_tokenised_once():
    """Also of a large vocabulary, chunk after chunk."""
    w, learned = packing.WordTokens(queries.tokenizer_path()), []
    learn = w._learn
    w._learn = lambda words, *rest: (learned.extend(words), learn(words, *rest))
    for _ in range(2):
        for part in range(4):
            data, offsets = tv.strings(pa.array([" ".join("ab" + str(k).translate(str.maketrans("0123456789", "qwertyuiop")) for k in range(part * 35000, part * 35000 + 35000))]))
            w.texts(data, offsets, 2)
    assert len(learned) == len(set(learned)) == 140000


def test_word_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    t, w, rng = Tokenizer.from_file(queries.tokenizer_path()), packing.WordTokens(queries.tokenizer_path(), most=500), random.Random(3)
    bits = ["a", "B", "é", "É", "ß", "×", "'s", "n't", ".", "!!", "<|endoftext|>", "<|ENDOFTEXT|>", "|", "…", "é", " ", "\x0b", "\x85", "日本", "İ", "Σ", "1", "23", "  ", "\n", "ÿ", "😀", "-", '"', "'LL", "\x00"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    ids, bounds = w.texts(*tv.strings(pa.array(texts)), 2)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [[*t.encode(x, add_special_tokens=False).ids, 2] for x in texts]


def test_windows_stay_bounded():
    w, rng = packing.Windows(100, 4, 10), random.Random(1)
    done = []
    for d in range(300):
        done += w.take(d, 0, rng.randint(0, 250))
        assert len(w.gaps) <= 4 and len(w.pieces) == len(w.gaps)
    done += w.close()
    assert all(sum(p[2] for p in s) <= 100 for s in done)


# 2 embeddings


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 16))
    rows = [(i, int(i % 3), (centres[i % 20] + 0.18 * rng.standard_normal(16)).tolist()) for i in range(300)]
    rows += [(300 + i, 1, rows[1][2]) for i in range(5)] + [(400, None, rows[0][2]), (401, 1, None), (402, 1, [0.0] * 16), (403, 1, [float("nan")] * 16), (404, 1, [None] * 16), (405, 1, []), (406, 0, [1.0, 2.0]), (407, 0, [2.0, 4.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, code string, pass int")
    got = {r.vec_id: r for r in near_vectors(df, window=16).collect()}
    stored = {r.vec_id: r.embedding for r in df.collect()}
    links, parent = collections.Counter(), {r[0]: r[0] for r in rows}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    good = [(i, lab) for i, lab, _ in rows if lab is not None and i not in (401, 402, 403, 404, 405)]
    for x, (i, a) in enumerate(good):
        for j, b in good[:x]:
            p, q = np.array(stored[i], float), np.array(stored[j], float)
            if a == b and len(p) == len(q) and p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= 0.93:
                links.update((i, j))
                u, v = sorted((find(i), find(j)))
                parent[v] = u
    assert sum(links.values()) > 500
    assert {k: (r.n_links, r.component_id, r.kept) for k, r in got.items()} == {k: (links[k], find(k), find(k) == k) for k in parent}
    assert near_vectors(df.limit(0)).isEmpty()


def brute_links(rows, least=0.93):
    """n_links and component of (vec_id, label, vector) rows without odd ones."""
    ids, labels = [r[0] for r in rows], np.array([r[1] for r in rows])
    unit = np.array([r[2] for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= least) & (labels[:, None] == labels)
    np.fill_diagonal(linked, False)
    low = np.array(ids)
    while True:
        new = np.array([min([low[i], *low[linked[i]]]) for i in range(len(ids))])
        if (new == low).all():
            return {k: (int(n), int(c)) for k, n, c in zip(ids, linked.sum(1), low, strict=True)}
        low = new


@pytest.mark.parametrize("whole", [512, 40])
def test_dense_run_over_partitions(spark, monkeypatch, whole):
    monkeypatch.setattr(embedding_dedup, "WHOLE", whole)
    monkeypatch.setattr(embedding_dedup, "BLOCK", whole // 2)
    rng = np.random.default_rng(3)
    dense = rng.standard_normal(16) + 0.1 * rng.standard_normal((300, 16))  # a run of many times the window, over all partitions
    pairs = np.repeat(rng.standard_normal((300, 16)), 2, axis=0) + 0.02 * rng.standard_normal((600, 16))
    rows = [(i, 0, v) for i, v in enumerate(np.concatenate((dense, pairs)).astype(np.float32).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    want = brute_links(rows)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df, window=16).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert got == want and sum(n for n, _ in want.values()) > 80_000


@pytest.mark.parametrize("sizes", [[40], [17, 23], [3, 1, 2, 30, 4], [1] * 40])
def test_neighbours_over_partition_edges(spark, monkeypatch, sizes):
    """Any cut into partitions marks the same vectors, also where partitions are smaller than the window."""
    codes = np.arange(40)
    far = np.where(codes % 8 == 0, 0, tv.mix(codes).view(np.int64))  # close: 0, 8, 16, ...
    marked = []
    for at, n in zip(np.cumsum([0, *sizes]), sizes, strict=False):
        part = slice(at, at + n)
        columns = [np.zeros(n, np.int64), codes[part], codes[part], far[part], far[part], codes[part]]
        batch = pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["grp", "code", "vec_id", "s0", "s1", "component"])

        class Here:
            partitionId = staticmethod(lambda k=len(marked): k)  # noqa: N815

        monkeypatch.setattr(embedding_dedup.TaskContext, "get", lambda here=Here: here)
        marked.append(pa.Table.from_batches(list(embedding_dedup._neighbours(9, 20)(iter([batch])))))
    monkeypatch.undo()
    near = spark.createDataFrame(pa.concat_tables(marked).to_pandas())
    over = embedding_dedup._edges(near, 9).groupBy("edge").applyInArrow(embedding_dedup._over_edges(20), "key long, vec_id long")
    got = {r.vec_id for r in near.filter("kind = 0").select("vec_id").union(over.select("vec_id")).collect()}
    assert got == {0, 8, 16, 24, 32}


def test_recall_on_the_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    more = df.filter("vec_id % 3 = 0").select((F.col("vec_id") + 1_000_000).alias("vec_id"), F.transform("embedding", lambda x, i: (x + 0.05 * F.sin(F.col("vec_id") + i)).cast("float")).alias("embedding"), "label")
    both = df.unionByName(more).cache()
    want = brute_links([(r.vec_id, r.label, r.embedding) for r in both.collect()])
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(both).collect()}
    assert got == want and sum(n for n, _ in want.values()) > 300


def test_vectors_of_odd_labels_and_ids(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(1, "a", v), (2, "a", w), (3, "b", v), (4, "0.2", v), (5, "0.7", v), (None, "a", v), (1, "a", v)]
    got = sorted(near_vectors(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")).collect(), key=lambda r: (r.vec_id is None, r.vec_id))
    assert [tuple(r) for r in got] == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (None, 0, None, True)]
    numbers = spark.createDataFrame([(1, 0.2, v), (2, 0.7, v), (3, 0.2, v)], "vec_id long, label double, embedding array<double>")
    assert {r.vec_id: r.component_id for r in near_vectors(numbers).collect()} == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("n", [1, 10**4, 10**6, 10**7, 10**8])
def test_passes_follow_the_largest_label(n):
    passes, bits = embedding_dedup.passes_for(n, 0.93, 256), np.ceil(np.log2(max(1, n / 256)))
    assert passes >= 20 and (1 - (1 - np.arccos(0.93) / np.pi) ** bits) ** passes <= 1e-4


# 3 substrings


def brute_substring(docs, window=20):
    words = {k: WORD.findall(t or "") for k, t in docs.items()}
    seen, gone = set(), collections.defaultdict(set)
    for k in sorted(words):
        for i in range(len(words[k]) - window + 1):
            w = tuple(words[k][i : i + window])
            if w in seen:
                gone[k].update(range(i, i + window))
            seen.add(w)
    return {k: (len(w), len(gone[k]), " ".join(x for i, x in enumerate(w) if i not in gone[k])) for k, w in words.items()}


@pytest.mark.parametrize(("block", "hot"), [(1 << 9, 512), (1 << 9, 2), (4 << 20, 0)])
def test_substring_dedup(odd, none, block, hot):
    out = substring_dedup.drop_repeated_phrases(odd, block_bytes=block, shard_bytes=1 << 12, hot=hot).collect()
    want = brute_substring(texts_of(odd))
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in out} == want
    assert all(sum(b - a for a, b in zip(r.removed[::2], r.removed[1::2])) == r.n_removed for r in out)
    assert sum(w[1] for w in want.values()) > 1000
    assert substring_dedup.drop_repeated_phrases(none).isEmpty()


def test_documents_stream_through_the_automata():
    """What goes is what the passages that a block gets say, whether it sent them itself or not."""
    words = [f"w{i}" for i in range(100)]
    table = pa.table({"block": pa.array([0] * 2, pa.int32()), "doc_id": [5, 6], "text": [" ".join(words[:50]), "x  " + "\n".join(words[10:40])]})

    def removed(passages):
        """Passages: (words, (document, shift)); all windows of one start there first."""
        runs = [np.array([x], np.int32).tobytes() for x in (1,)]
        rows = [(0, [" ".join(p)], runs[0], np.array([len(p) - 19], np.int32).tobytes(), np.array([d], np.int64).tobytes(), np.array([x], np.int32).tobytes()) for p, (d, x) in passages]
        columns = list(zip(*rows, strict=True))
        types = [pa.int32(), pa.list_(pa.string()), *[pa.binary()] * 4]
        firsts = pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in substring_dedup.FIRSTS.split(", ")])
        return substring_dedup._remove(20)(table, firsts)["n_removed"].to_pylist()

    assert removed([(words[10:35], (5, 10))]) == [0, 25]
    assert removed([(words[10:30], (1, 0)), (words[20:40], (5, 20))]) == [20, 30]
    assert removed([([*words[10:20], "other", *words[21:35]], (1, 0))]) == [0, 0]


def test_phrases_of_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    out = substring_dedup.drop_repeated_phrases(odd_ids(spark, text), block_bytes=1).collect()
    got = sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_removed) for r in out)
    assert got == [(False, 2, 30, 0), (False, 2, 60, 30), (False, 3, 30, 30), (False, 7, 0, 0), (True, None, 3, 0), (True, None, 30, 30)]
    alone = spark.createDataFrame([(None, text), (4, f"{text} x {text}"), (None, f"y {text}")], "doc_id long, text string")
    assert sorted(r.n_removed for r in substring_dedup.drop_repeated_phrases(alone).collect()) == [30, 30, 30]


# 4 lines


def brute_lines(docs, least=10):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for k, t in docs.items():
        for x in (t or "").split("\n"):
            holders[key(x)].add(k)
    out = {}
    for k, t in docs.items():
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < least or len(holders[key(x)]) < 2 or min(holders[key(x)]) == k]
        out[k] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


@pytest.mark.parametrize("block", [1 << 9, 4 << 20])
def test_line_dedup(odd, none, block):
    out = line_dedup.drop_repeated_lines(odd, carry=["lang", "source"], block_bytes=block, shard_bytes=1 << 10).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in out} == brute_lines(texts_of(odd))
    assert {r.doc_id: (r.lang, r.source) for r in out} == {r.doc_id: (r.lang, r.source) for r in odd.collect()}
    assert line_dedup.drop_repeated_lines(none).isEmpty()


def test_perfect_hash():
    keys = tv.mix(np.arange(50_000, dtype=np.uint64))
    mph = line_dedup.PerfectHash(keys)
    assert mph.size == len(keys) and sorted(mph.index(keys).tolist()) == list(range(len(keys)))


def test_lines_with_one_hash_are_told_apart():
    h, p = np.array([7, 7, 7, 9], np.uint64), np.array([1, 2, 1, 1], np.uint32)
    arrays = line_dedup.Arrays.build(h, p, np.array([5, 3, 8, 4]), np.array([1, 1, 3, 1], np.uint32))
    arrays = line_dedup.Arrays.of_row(dict(zip([x.split()[0] for x in line_dedup.ARRAYS.split(", ")], arrays.row(0), strict=True)))
    n, first = arrays.probe(np.array([7, 7, 9, 9, 8], np.uint64), np.array([1, 2, 1, 2, 1], np.uint32))
    assert n.tolist() == [4, 1, 1, 0, 0] and first.tolist() == [5, 3, 4, 0, 0]


def test_documents_probe_the_published_arrays():
    """What goes is what the arrays say: with other counts or fingerprints in them, other lines stay."""
    table = pa.table({"block": pa.array([0] * 3, pa.int32()), "doc_id": [1, 2, 3], "text": ["a common line\nown line one", "a common line\nown line two", "A COMMON LINE "]})

    def dropped(change):
        sent = line_dedup._send(1, 10)(table)
        published = line_dedup._publish(sent)
        row = published.to_pylist()[0]
        row |= change(row)
        published = pa.table({k: pa.array([v], published.schema.field(k).type) for k, v in row.items()})
        return line_dedup._apply(1, 10, [])(table, line_dedup._probe(sent, published))["n_dropped"].to_pylist()

    counts = lambda r: np.frombuffer(r["counts"], np.int64)
    assert dropped(lambda r: {}) == [0, 1, 1]
    assert dropped(lambda r: {"counts": np.ones_like(counts(r)).tobytes()}) == [0, 0, 0]
    assert dropped(lambda r: {"counts": np.full_like(counts(r), 2).tobytes(), "firsts": np.zeros_like(counts(r)).tobytes()}) == [2, 2, 1]
    assert dropped(lambda r: {"prints": bytes(len(r["prints"]))}) == [0, 0, 0]


def odd_ids(spark, text="the same long line here"):
    """Rows with null and repeated doc_ids: 2 holds the line three times in two rows, two rows without an id hold it too."""
    rows = [(3, text), (2, f"{text}\n{text}"), (2, text), (None, text), (None, "something else entirely"), (7, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_lines_of_null_and_repeated_ids(spark):
    for block in (1, 4 << 20):
        out = line_dedup.drop_repeated_lines(odd_ids(spark), block_bytes=block).collect()
        got = sorted((r.doc_id is None, r.doc_id, r.n_lines, r.n_dropped) for r in out)
        assert got == [(False, 2, 1, 0), (False, 2, 2, 0), (False, 3, 1, 1), (False, 7, 1, 0), (True, None, 1, 0), (True, None, 1, 1)]
    alone = spark.createDataFrame([(None, "one line only, twice"), (None, "one line only, twice")], "doc_id long, text string")
    assert [r.n_dropped for r in line_dedup.drop_repeated_lines(alone).collect()] == [0, 0]


# 5 quality


def test_quality_is_learned(spark, sf):
    out = queries.op5_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality IN (0, 1)")
    r = out.join(labels, "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 10 and r.a >= 0.95
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, None), (99, 1)], "doc_id long, quality int")
    model = quality.quality_model(quality.measured(odd), labels)
    out = quality.classify(odd, model)
    assert out.columns == [*(c for c in odd.columns if c != "score"), "score", "predicted"]
    assert out.filter("score BETWEEN 0 AND 1").count() == odd.count()
    scored = {r.doc_id: round(r.score, 9) for r in quality.scored(quality.measured(odd), model).collect()}
    assert scored == {r.doc_id: round(r.score, 9) for r in out.collect()}
    blank = quality.quality_model(quality.measured(none), labels)
    assert {r.score for r in quality.classify(odd, blank).collect()} == {0.5}
    assert quality.classify(none, model).isEmpty()


def test_whitening_gives_the_density():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 3)) @ rng.standard_normal((3, 3))
    n, total, outer = np.array([400.0, 0]), np.stack([x.sum(0), np.zeros(3)]), np.stack([x.T @ x, np.zeros((3, 3))])
    m = quality.model_of(n, total, outer, pooled=0, spherical=0)
    cov = np.cov(x.T, bias=True) + 1e-6 * np.eye(3)
    d = x[:5] - x.mean(0)
    assert np.allclose(((d @ m.whiten[0].T) ** 2).sum(1), (d @ np.linalg.inv(cov) * d).sum(1))
    assert np.isclose(m.half_log_det[0], 0.5 * np.linalg.slogdet(cov)[1])


# 6 chat


def fold(spark, events):
    schema = "conv_id long, turn long, seq long, kind string, role string, text string"
    parts = chat.format_chats(spark.createDataFrame(events, schema)).collect()
    out = collections.defaultdict(list)
    for r in sorted(parts, key=lambda r: (str(r.conv_id), r.part)):
        out[r.conv_id].append(chat.read_back(r.formatted))
        if r.loss_from is not None:
            assert chat.unescape(r.formatted[r.loss_from : r.loss_to]) == chat.read_back(r.formatted)[1]
    return dict(out)


def test_events_fold(spark):
    got = fold(spark, [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", "a"), (1, 1, 2, "delta", None, "b"), (1, 1, 3, "delta", None, "c"),
        (1, 2, 4, "message", "user", "more"), (1, 3, 5, "message", "assistant", "old"), (1, 1, 6, "regenerate", "assistant", "new"), (1, 1, 7, "delta", None, "!"), (1, 2, 8, "message", "user", "again"),
        (2, 0, 0, "message", "user", "typo"), (2, 0, 5, "edit", None, "fixed"), (2, 0, 6, "odd", "user", "x"), (3, 0, 0, "edit", None, "x"), (4, 0, 0, "delta", "user", "y"), (None, None, None, None, None, None),
    ])
    assert got == {1: [("user", "hi"), ("assistant", "new!"), ("user", "again")], 2: [("user", "fixed")], 4: [("user", "y")], None: [("", "")]}


def test_rendering_is_reversible():
    rng = random.Random(2)
    bits = ["\\", "<", ">", "</turn>", "<turn user>\n", "\n", "n", "é", "### Assistant:", ""]
    for _ in range(3000):
        role, text = ("".join(rng.choice(bits) for _ in range(rng.randint(0, 6))) for _ in range(2))
        part, a, b = chat.render(role, text)
        assert chat.read_back(part) == (role, text) and chat.unescape(part[a:b]) == text
        assert part.count("<turn ") == 1 and part.count("</turn>") == 1


def test_conversations(spark, sf):
    got = {r.conv_id: r for r in queries.op6_chat_formatting(spark, sf).collect()}
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    text = r"\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", text), (1, "assistant", text)]
    for k, v in turns.items():
        v.sort()
        said = "".join(x for _, role, x in v if role == "assistant")
        want = (len(v), hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in v).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
        assert tuple(got[k])[1:5] == want
    assert got.keys() == turns.keys()


# 7 mixing


def brute_targets(sizes, weights, cap):
    open_, out, total = set(range(len(sizes))), [0.0] * len(sizes), float(sum(sizes))
    while open_:
        unit = total / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * unit > cap * sizes[i]}
        if not over:
            for i in open_:
                out[i] = weights[i] * unit
            return out
        for i in over:
            out[i] = cap * sizes[i]
            total -= out[i]
        open_ -= over
    return out


@pytest.mark.parametrize("sizes", [[100, 10, 1000, 0], [0, 0], [], [7, 1, 50, 3, 900, 2, 40, 11]])
def test_targets_and_tilts(spark, sizes):
    names = [*(f"s{i}" for i in range(len(sizes) - 1)), None][: len(sizes)]
    totals = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, total long")
    want = brute_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3.0)
    rows = mixing.with_targets(totals, (5, 2, 1), 3.0)
    got = {r.source: r.target for r in rows.collect()}
    assert [got[n] for n in names] == pytest.approx(want)
    counts = totals.select("source", F.greatest("total", F.lit(1)).alias("size"), F.when(F.col("total") > 0, 1).otherwise(0).alias("n"))
    tilts = {r.source: r.tilt for r in mixing.with_tilts(rows, counts, 3.0).collect()}
    assert [size * min(3.0, np.exp(tilts[n])) for n, size in zip(names, sizes, strict=True)] == pytest.approx(want)


def plain_tilt(sizes, n, target, cap):
    """lambda (by mean size) of one source, by halving alone."""
    sizes, n = np.array(sizes, float), np.array(n, float)
    scale = (sizes * n).sum() / n[sizes > 0].sum()
    tokens = lambda tilt: (sizes * n * np.exp(np.minimum(np.log(cap), tilt * sizes / scale))).sum()
    low, high = -1.0, 1.0
    while tokens(low) > target:
        low *= 2
    while tokens(high) < target:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if tokens(middle) < target else (low, middle)
    return low, scale


def test_rates_tilt_with_size(spark):
    rng = np.random.default_rng(5)
    sources = {"grows": 2.1, "shrinks": 0.2, "stays": 1.0, "nearly all": 2.999, "nearly nothing": 1e-4}
    counts, totals, want = [], [], {}
    for name, part in sources.items():
        sizes = np.unique(np.append(rng.lognormal(5, 1.5, 60).astype(int) + 1, 0))
        n = rng.integers(1, 50, len(sizes))
        total = int((sizes * n).sum())
        counts += [(name, int(a), int(b)) for a, b in zip(sizes, n, strict=True)]
        totals.append((name, total, part * total))
        want[name] = (*plain_tilt(sizes, n, part * total, 3.0), sizes, n)
    got = {r.source: r for r in mixing.with_tilts(spark.createDataFrame(totals, "source string, total long, target double"), spark.createDataFrame(counts, "source string, size long, n long"), 3.0).collect()}
    for name, total, target in totals:
        tilt, scale, sizes, n = want[name]
        assert got[name].scale == pytest.approx(scale) and got[name].tilt == pytest.approx(tilt, rel=1e-4, abs=1e-6)
        rates = np.exp(np.minimum(np.log(3), got[name].tilt * sizes / scale))
        assert (sizes * n * rates).sum() == pytest.approx(target, rel=1e-8)
    rates = lambda name: np.exp(np.minimum(np.log(3), got[name].tilt * want[name][2] / want[name][1]))
    assert rates("grows")[1] < rates("grows")[10] <= 3 and rates("shrinks")[1] > rates("shrinks")[10] > 0
    assert got["grows"].steps > 3 and got["shrinks"].steps > 3 and got["stays"].tilt == 0 and got["stays"].steps == 1


def test_copies_are_the_rounded_rates(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PARTS", 3)
    monkeypatch.setattr(mixing, "_corrections", lambda rounded, cap, part, rank, change: rounded.select("source", "size", part, rank, F.lit(0).cast("long").alias(change)).limit(0))
    rng = np.random.default_rng(1)
    sized = spark.createDataFrame([(k, "ab"[k % 2], int(rng.integers(0, 30))) for k in range(400)], "doc_id long, source string, size long")
    rows = sized.withColumn("h", F.xxhash64("doc_id")).collect()
    got = {r.doc_id: r for r in mixing.mix(sized).collect()}
    for source in "ab":
        mine = sorted((r for r in rows if r.source == source), key=lambda r: (r.size, r.h % 3, r.h))
        target = got[mine[0].doc_id].target
        sizes, n = np.unique([r.size for r in mine], return_counts=True)
        tilt, scale = plain_tilt(sizes, n, target, 3.0)
        at = 0.0
        for r in mine:
            rate = np.exp(min(np.log(3), tilt * r.size / scale))
            assert got[r.doc_id].rate == pytest.approx(rate, rel=1e-6)
            assert got[r.doc_id].copies == np.floor(at + rate + 0.5) - np.floor(at + 0.5) or abs((at + rate + 0.5) % 1 - 0.5) > 0.4999
            at += rate


def test_very_small_targets_converge(spark):
    rows = spark.createDataFrame([("a", 10**15, 1e-3), ("b", 10, 29.0)], "source string, total long, target double")
    counts = spark.createDataFrame([("a", 10**15, 1), ("b", 10, 1)], "source string, size long, n long")
    got = {r.source: r.tilt for r in mixing.with_tilts(rows, counts, 3.0).collect()}
    assert got["a"] == pytest.approx(np.log(1e-18)) and got["b"] == pytest.approx(np.log(2.9))


def test_mixing_of_clashing_columns_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PARTS", 3)
    rows = [(i % 5 if i % 7 else None, ("a", None)[i % 2], i % 4, 1.0, "x", "y", "z", 2) for i in range(60)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, rate double, _part string, _size string, size_ string, __change int")
    out = mixing.mix(sized)
    got = out.collect()
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=repr) == sorted(((d, s, n) for d, s, n, *_ in rows), key=repr)
    assert {(r["_part"], r["_size"], r["size_"], r["__change"]) for r in got} == {("x", "y", "z", 2)} and out.columns.count("rate") == 1
    for s in ("a", None):
        group = [r for r in got if r.source == s]
        assert all(0 <= r.copies <= 3 for r in group) and abs(sum(r.taken for r in group) - group[0].target) <= 3


def test_mixing(spark, odd, none, sf):
    for docs in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        docs = docs.drop("copies")
        sized = docs.withColumn("size", mixing.word_count(F.col("text")))
        out = mixing.mix(sized)
        rows = out.collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
        assert {r.doc_id: r.size for r in rows} == {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
        by = collections.defaultdict(list)
        for r in rows:
            assert 0 <= r.taken <= 3 * r.size
            by[r.source].append(r)
        for group in by.values():
            assert abs(sum(r.taken for r in group) - group[0].target) <= max(r.size for r in group)
            assert group[0].source_size == sum(r.size for r in group)
        total = sum(r.size for r in rows)
        assert abs(sum(g[0].target for g in by.values()) - total) < 1e-6 * total
        again = mixing.mix(sized.repartition(7)).collect()
        assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in rows}
    assert mixing.mix(none.withColumn("size", mixing.word_count(F.col("text")))).isEmpty()


# 8 language


def test_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = queries.op8_language_id(spark, sf)
    r = out.join(docs, "doc_id").filter("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()
    assert r.a >= 0.97 and out.filter("score < 0 OR score > 1").isEmpty()


def test_mixtures_and_odd_texts(spark, odd, none, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("lang IN ('en', 'de')")
    model = langid.fit(docs)
    one = {lang: docs.filter(f"lang = '{lang}'").agg(F.max_by("text", F.length("text")).alias("t")).first().t[:3000] for lang in ("en", "de")}
    both = spark.createDataFrame([(1, one["en"] + " " + one["de"]), (2, one["en"])], "doc_id long, text string")
    got = {r.doc_id: r.languages for r in langid.identify(both, model).collect()}
    assert {x.lang for x in got[1]} == {"en", "de"} and all(x.share > 0.2 for x in got[1]) and [x.lang for x in got[2]] == ["en"]
    out = {r.doc_id: r.lang_pred for r in langid.identify(odd, model).collect()}
    und = {i for i, t in enumerate(odd_texts()) if not any(c.isalpha() for c in t or "")}
    assert {k for k, v in out.items() if v == "und"} == und and len(out) == odd.count()
    empty = langid.fit(none)
    assert {r.lang_pred for r in langid.identify(odd, empty).collect()} == {"und"} and langid.identify(none, model).isEmpty()


# 9 near duplicates


def brute_near(docs, k=5, percent=75):
    sets = {}
    for d, t in docs.items():
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def test_near_duplicates(odd, none):
    out = near_dedup.near_duplicates(odd).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == brute_near(texts_of(odd))
    assert near_dedup.near_duplicates(none).isEmpty()


def test_dense_regions(spark):
    """A hub with 60 copies that mostly link through it alone, chains of edits, and a passage that many share."""
    rng = random.Random(11)
    fresh = lambda n: [f"u{rng.randint(0, 10**9)}" for _ in range(n)]
    hub, texts = fresh(200), []
    texts.append(hub)
    for _ in range(60):
        copy = list(hub)
        at = rng.randint(0, 175)
        copy[at : at + 20] = fresh(20)
        texts.append(copy)
    chain = fresh(150)
    for _ in range(30):
        texts.append(list(chain))
        at = rng.randint(0, 140)
        chain[at : at + 8] = fresh(8)
    passage = fresh(60)
    texts += [[*fresh(90), *passage, *fresh(30)] for _ in range(60)]
    docs = {i: " ".join(t) for i, t in enumerate(texts)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()} == brute_near(docs)


def hub_of_a_wide_region():
    """A hub, copies that link through it alone and share three values with it in some order but all in none, and a crowd that shares values and links with nothing."""
    rng = random.Random(12)
    fresh = lambda n: [f"u{rng.randint(0, 10**9)}" for _ in range(n)]
    hub = fresh(200)

    def edited(at, n):
        return [*hub[:at], *fresh(n), *hub[at + n :]]

    def minima(words):
        _, value = near_dedup.shingle_sets(*tv.strings(pa.array([" ".join(words)])), 5)
        return ((value[:, None] * near_dedup._A + near_dedup._B) >> np.uint64(32)).min(0).reshape(near_dedup.TREES, near_dedup.DEPTH)

    def common(words):
        return np.cumprod(minima(words) == minima(hub), axis=1).sum(1).max()

    texts = [hub]
    for at in range(0, 177, 3):
        texts.append(next(x for x in iter(lambda: edited(at, 23), None) if 3 <= common(x) < near_dedup.DEPTH))
    texts += [edited(rng.randint(0, 160), 40) for _ in range(300)]
    rng.shuffle(texts)
    return {i: " ".join(x) for i, x in enumerate(texts)}


@pytest.mark.parametrize("region,size", [(32, 4 << 20), (4096, 6000)])
def test_regions_wider_than_a_task(spark, monkeypatch, region, size):
    monkeypatch.setattr(near_dedup, "REGION", region)
    monkeypatch.setattr(near_dedup, "REGION_SHINGLES", size)
    docs = hub_of_a_wide_region()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()} == brute_near(docs)


def test_reach_over_partition_edges():
    """What the partitions of an order miss at their edges, a second run over their edge rows finds."""
    key = lambda i: np.array([i // 7, *[5] * 5], ">u4").tobytes()
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([0] * len(rows), pa.int32()), pa.array([k for k, _ in rows], pa.binary()), pa.array([d for _, d in rows], pa.int64())], names=["tree", "key", "doc_id"])
    rows = [(key(i), i) for i in range(60)]
    pairs = lambda out: {(r["a"], r["b"], r["cut"]) for x in out for r in x.to_pylist() if r["key"] is None}
    whole, parts, edges = pairs(near_dedup._neighbours(iter([batch(rows)]))), set(), set()
    for a, b in ((0, 3), (3, 20), (20, 24), (24, 60)):
        out = list(near_dedup._neighbours(iter([batch(rows[a : (a + b) // 2]), batch(rows[(a + b) // 2 : b])])))
        parts |= pairs(out)
        edges |= {(r["key"], r["a"]) for x in out for r in x.to_pylist() if r["key"] is not None}
    assert parts < whole and parts | pairs(near_dedup._neighbours(iter([batch(sorted(edges))]))) >= whole


def test_regions_are_named_alike_in_all_batches():
    """A region's name is the prefix of its keys, whichever batch of the order it was cut in."""
    key = lambda i: np.array([1 + i // 12, 2, 3, i % 12, 5, 6], ">u4").tobytes()
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([0] * len(rows), pa.int32()), pa.array([key(i) for i in rows], pa.binary()), pa.array(rows, pa.int64())], names=["tree", "key", "doc_id"])
    cut = lambda out: {(r["a"], r["b"], r["short"]) for x in out for r in x.to_pylist() if r["cut"]}
    whole = cut(near_dedup._neighbours(iter([batch(list(range(120)))])))
    assert {short for *_, short in whole} == {key(i)[: 4 * near_dedup.REST] for i in range(120)}
    assert cut(near_dedup._neighbours(iter([batch(list(range(a, a + 30))) for a in range(0, 120, 30)]))) == whole


# 10 fingerprints


def test_fingerprints(odd, none):
    docs = sorted(texts_of(odd).items(), reverse=True)
    got = {r.doc_id: r for r in fingerprints.edited_neighbours(odd).collect()}
    assert len(got) == len(docs)
    for (k, t), (_, u) in zip(docs, docs[1:] + docs[:1], strict=True):
        t, u = t or "", u or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        r = got[k]
        assert (r.n_chars, r.edited) == (len(t), edited)
        assert r.near_edited == fingerprints.likeness(r.fingerprint, r.edited_fingerprint) and 0 <= r.near_next <= 1
    same = collections.defaultdict(set)
    for k, t in docs:
        same[t or ""].add(got[k].fingerprint)
    assert all(len(s) == 1 for s in same.values())
    made = {r.doc_id: r.f for r in odd.select("doc_id", fingerprints.fingerprint(F.col("text")).alias("f")).collect()}
    assert made == {k: r.fingerprint for k, r in got.items()}
    assert fingerprints.edited_neighbours(none).isEmpty()
    sketches = {k: brute_sketch(t or "") for k, t in docs}
    for (k, _), (next_, _) in zip(docs, docs[1:] + docs[:1], strict=True):
        a, b, c = sketches[k], sketches[next_], brute_sketch(got[k].edited)
        assert set(fingerprints.decode(got[k].fingerprint)[0].tolist()) == a[0]
        for near, other in ((got[k].near_next, b), (got[k].near_edited, c)):
            whole = a[0] | other[0]
            assert near == pytest.approx(len(a[0] & other[0]) / len(whole) if whole else float(a[1] == other[1]))


def brute_sketch(text, k=5):
    """Retained hashes and all shingles, one text at a time and word by word."""
    words = WORD.findall(text)
    hashes = tv.HASH_A.ranges(np.frombuffer("\0".join(words).encode(), np.uint8), *(np.array(x, np.int64) for x in zip(*spans(words), strict=True))) if words else []
    sets = {tuple(words[i : i + k]): hashes[i : i + k] for i in range(max(1, len(words) - k + 1))} if words else {}
    full = {tv.runs(h, k)[0] for h in sets.values() if len(h) == k}
    short = {int(tv.mix((h * (tv._table(78, k) | np.uint64(1))[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))[0]) for h in sets.values() if len(h) < k}
    return {int(h) for h in full | short if int(h) < (1 << 64) // fingerprints.SCALE}, frozenset(sets)


def spans(words):
    at = 0
    for w in words:
        n = len(w.encode())
        yield at, at + n
        at += n + 1


def test_followers_of_null_and_repeated_ids(spark):
    rows = [(3, "three"), (1, "one a"), (1, "one b"), (None, "none a"), (None, "none b"), (2, None)]
    got = fingerprints.edited_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_chars) for r in got) == sorted((d is None, d, len(t or "")) for d, t in rows)
    first = next(r for r in got if r.doc_id == 3)
    assert first.edited == "thr" and next(r for r in got if r.doc_id == 2).edited == ""
    assert {r.edited[-2:] for r in got if r.doc_id == 1} <= {"on", "no"}
    alone = fingerprints.edited_neighbours(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert [(r.edited, r.near_next) for r in alone] == [("abab", 1.0)]


def test_sketches_estimate(spark):
    a, b = (" ".join(f"w{i}" for i in range(lo, hi)) for lo, hi in ((0, 4000), (2000, 4000)))
    x, y = (fingerprints.encode(h[0], int(d[0])) for h, d in (fingerprints.sketch(*tv.strings(pa.array([t]))) for t in (a, b)))
    assert abs(fingerprints.likeness(x, y) - 0.5) < 0.06 and fingerprints.containment(y, x) > 0.99 and abs(fingerprints.containment(x, y) - 0.5) < 0.06
    assert fingerprints.decode(fingerprints.merge(x, y))[0].tolist() == fingerprints.decode(x)[0].tolist()


# queries against SQL


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, sf, name):
    db = duckdb.connect()
    path = f"{sf}/documents.parquet"
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    found = db.execute(queries.SQL[name])
    names = [d[0] for d in found.description]
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


# rows without an id


def test_rows_without_an_id_are_dealt_and_count_as_one_document(spark):
    words = " ".join(f"w{i}" for i in range(25))
    rows = [(None, f"row number {i} of many\nheld by rows without an id only\nheld by five as well\n{words}") for i in range(40)]
    rows += [(5, "held by five as well\nfive alone says this"), (6, f"{words} and more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = blocks.in_blocks(docs, 8, "doc_id", "text").filter("doc_id IS NULL").select("block").distinct().count()
    assert dealt > 3
    of = lambda df, *columns: sorted(map(tuple, df.select("doc_id", "text", *columns).collect()), key=repr)
    lines = [of(line_dedup.drop_repeated_lines(docs, block_bytes=size, shard_bytes=size), "n_lines", "n_dropped") for size in (1 << 20, 64, 1000)]
    assert lines[0] == lines[1] == lines[2]
    kept = {r[1] for r in lines[0] if r[0] is None}
    assert all("without an id only" in t and "five" not in t for t in kept)  # one document holds the one, two hold the other
    phrases = [of(substring_dedup.drop_repeated_phrases(docs, block_bytes=size, shard_bytes=size), "n_words", "n_removed") for size in (1 << 20, 200, 1000)]
    assert phrases[0] == phrases[1] == phrases[2] and all(r[3] >= 25 for r in phrases[0] if r[0] is None)
