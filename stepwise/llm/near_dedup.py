"""MinHash near-deduplication by an LSH forest.

Documents with equal shingle sets are one class, and only its smallest doc_id goes
on. The forest is `TREES` sorted orders, each by `DEPTH` minimum hashes of its own.
In each order a document's candidates are the places that share the longest prefixes
with it, and how far they may lie depends on the prefix: `REACH` places for that many
values in common. So the depth adapts to the region: where an order is sparse, short
prefixes count; in a dense one only longer ones do.

Candidates that the 96 minimum hashes put below `ESTIMATE` (four deviations under
the threshold) are dropped; all others are verified on full shingle sets. Regions of
`REST` values that are longer than their reach are looked at again, whole: a task
gets the shingle sets of one region, counts all intersections by matrix products and
gives back one row for each document that something links to. A region too large for
that is cut into blocks, and every pair of blocks that several components meet in is
a task. So the reach loses nothing, and no pairs of a dense region leave its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .components import components

TREES, DEPTH = 16, 6
#: Values in common: places away.
REACH = {2: 2, 3: 4}
#: Values that a region looked at again has in common; about the most documents and shingles that a task compares.
REST, REGION, REGION_SHINGLES = 3, 4096, 4 << 20
ESTIMATE = 0.57
#: The second look chooses up to this many texts by a broadcast of ids (8 bytes each); more, by a join.
BROADCAST_IDS = 100_000

_A = tv._table(901, TREES * DEPTH) | np.uint64(1)
_B = tv._table(902, TREES * DEPTH)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle hash), ordered, of texts with A-Z in lower case."""
    return tv.unique_pairs(*tv.shingles(tv.Words(tv.lower(data), offsets), k))


def sketches(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (128 bits that tell sets apart), signature (32-bit minima; empty for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column("doc_id"), batch.column("text")
            for a, b in tv.pieces(text):
                row, value = shingle_sets(*tv.strings(text.slice(a, b - a)), k)
                n = np.bincount(row, minlength=b - a)
                some = np.flatnonzero(n)
                at = np.flatnonzero(np.diff(row, prepend=-1))
                digest = np.zeros((2, b - a), np.uint64)
                minima = np.zeros((len(some), TREES * DEPTH), np.uint32)
                if len(some):
                    digest[0, some] = np.add.reduceat(tv.mix(value ^ np.uint64(0x5851F42D4C957F2D)), at)
                    digest[1, some] = np.add.reduceat(tv.mix(value + np.uint64(0x14057B7EF767814F)), at)
                    for p in range(TREES * DEPTH):
                        minima[:, p] = np.minimum.reduceat((value * _A[p] + _B[p]) >> np.uint64(32), at)
                signature = np.full(b - a, b"", object)
                signature[some] = [x.tobytes() for x in minima]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n, pa.int64()), *(pa.array(x.view(np.int64)) for x in digest), pa.array(signature, pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, signature binary")


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, TREES, DEPTH).astype(">u4")
        n = len(sig)
        for tree in range(TREES):
            keys = np.ascontiguousarray(sig[:, tree]).view(f"S{4 * DEPTH}") if n else np.zeros((0, 1), f"S{4 * DEPTH}")
            raw = pa.Array.from_buffers(pa.binary(4 * DEPTH), n, [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, tree, np.int32)), raw, batch.column("doc_id"), batch.column("n_shingles")], names=["tree", "key", "doc_id", "n_shingles"])


NEAR = ["a", "b", "cut", "tree", "short", "key"]
NEAR_ROWS = "a long, b long, cut boolean, tree int, short binary, key binary"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of (tree, key): pairs within reach; cut marks those just beyond the reach of REST values that share them (short).

    Rows with a key instead of a b are the first and last of the partition, which may reach into others.
    """
    far = max(REACH.values())
    need = [min(k for k, places in REACH.items() if places >= step) for step in range(1, far + 1)] + [DEPTH + 1]
    held, first = None, None
    edge = lambda rows: pa.RecordBatch.from_arrays([rows["doc_id"], pa.nulls(len(rows), pa.int64()), pa.array(np.zeros(len(rows), bool)), rows["tree"], pa.nulls(len(rows), pa.binary()), rows["key"]], names=NEAR)
    for batch in batches:
        if not len(batch):
            continue
        ends = pa.Table.from_batches([batch.select(["tree", "key", "doc_id"])])
        first = ends if first is None else first if len(first) > far else pa.concat_tables([first, ends])
        first = first.slice(0, far + 1)
        last = ends if held is None else pa.concat_tables([last, ends])
        last = last.slice(max(0, len(last) - far - 1))
        tree, ids = batch.column("tree").to_numpy(), batch.column("doc_id").to_numpy()
        keys = np.frombuffer(tv.strings(batch.column("key"))[0].tobytes(), ">u4").reshape(-1, DEPTH)
        if held is not None:
            tree, ids, keys = np.concatenate((held[0], tree)), np.concatenate((held[1], ids)), np.concatenate((held[2], keys)).astype(">u4")  # concatenate turns bytes into the machine's order, and prefixes are compared as bytes
        old = 0 if held is None else len(held[0])
        after = np.where(tree[1:] == tree[:-1], np.cumprod(keys[1:] == keys[:-1], axis=1).sum(1), 0)  # in common with the next
        common, out = after, [(ids[:0], ids[:0], ids[:0] > 0, tree[:0], ids[:0])]
        for step, least in enumerate(need, 1):
            if step > 1:
                common = np.minimum(common[:-1], after[step - 1 :])
            i = np.flatnonzero(common >= least)
            i = i[i + step >= old]
            out.append((ids[i], ids[i + step], np.zeros(len(i), bool), tree[i], i))
            if step == REACH[REST] + 1:
                i = np.flatnonzero(common >= REST)
                i = i[i + step >= old]
                out.append((ids[i], ids[i + step], np.ones(len(i), bool), tree[i], i))
            if not len(common):
                break
        a, b, cut, t, at = (np.concatenate(x) for x in zip(*out, strict=True))
        short = pa.array([x.tobytes() if c else None for x, c in zip(keys[at, :REST], cut.tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cut), pa.array(t, pa.int32()), short, pa.nulls(len(a), pa.binary())], names=NEAR)
        held = tree[-far - 1 :], ids[-far - 1 :], keys[-far - 1 :]
    if first is not None:
        for rows in (first, last):
            yield edge(rows.combine_chunks().to_batches()[0])


def _likely(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs(a, b) whose signatures agree in a share of at least ESTIMATE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, TREES * DEPTH) for c in ("sig_a", "sig_b"))
            share = (left == right).mean(1) if len(left) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(share >= ESTIMATE))

    left = known.select(F.col("doc_id").alias("a"), F.col("signature").alias("sig_a"))
    right = known.select(F.col("doc_id").alias("b"), F.col("signature").alias("sig_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs(a, b) whose full shingle sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bytes_each = sum(np.diff(tv.strings(batch.column(c))[1]) for c in ("text_a", "text_b"))
            edges = np.flatnonzero(np.diff(np.cumsum(bytes_each) // tv.CHUNK_BYTES, prepend=0)) if len(bytes_each) else []
            for rows in np.split(np.arange(len(bytes_each)), edges):
                if not len(rows):
                    continue
                part = batch.slice(int(rows[0]), len(rows))
                sets = [shingle_sets(*tv.strings(part.column(c)), k) for c in ("text_a", "text_b")]
                row, value = (np.concatenate(x) for x in zip(*sets, strict=True))
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                both = np.bincount(row[1:][(row[1:] == row[:-1]) & (value[1:] == value[:-1])], minlength=len(rows))
                union = np.bincount(row, minlength=len(rows)) - both
                yield part.select(["a", "b"]).filter(pa.array((100 * both >= percent * union) & (union > 0)))

    texts = docs.select("doc_id", "text")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (doc_id = component_id).

    A document's set is its distinct k-word shingles, words being runs without ASCII
    white space, A-Z in lower case; with fewer words the whole sequence is the only
    shingle; null and empty texts have an empty set and link with nothing. Documents
    link if 100 * intersection >= percent * union. doc_id is taken to be a key: rows
    that share one are one document in links, all with its component. Rows without a
    doc_id link with nothing and are kept, with null as their component. An empty table
    gives an empty one; other columns are ignored.
    """
    everything = sketches(docs, k).checkpoint()
    docs, known = docs.filter("doc_id IS NOT NULL"), everything.filter("doc_id IS NOT NULL")
    filled = known.filter("n_shingles > 0")
    same = ["set_a", "set_b", "n_shingles"]
    classes = filled.groupBy(*same).agg(F.min_by("signature", "doc_id").alias("signature"), F.min("doc_id").alias("doc_id"))
    leads = classes.select("doc_id", "n_shingles", "signature").checkpoint()

    orders = leads.mapInArrow(_orders, "tree int, key binary, doc_id long, n_shingles long").drop("n_shingles").repartitionByRange("tree", "key", "doc_id").sortWithinPartitions("tree", "key", "doc_id")
    near = orders.mapInArrow(_neighbours, NEAR_ROWS).checkpoint()
    edges = near.filter("key IS NOT NULL").select("tree", "key", F.col("a").alias("doc_id")).distinct().coalesce(1).sortWithinPartitions("tree", "key", "doc_id")
    over = edges.mapInArrow(_neighbours, NEAR_ROWS)  # a few rows of each partition
    near = near.union(over).filter("key IS NULL").drop("key").checkpoint()
    likely = _likely(near.filter("NOT cut").select("a", "b").distinct(), leads).checkpoint()
    links = verified(likely, docs, k, percent).checkpoint()
    found = components(links.toDF("u", "v")).checkpoint()

    more = _inside(_regions(near, leads, found), docs, k, percent).checkpoint()
    if not more.isEmpty():
        found = components(found.toDF("u", "v").union(more)).checkpoint()

    lead_of = classes.select(*same, F.col("doc_id").alias("lead")).join(found.withColumnRenamed("node", "lead"), "lead", "left")
    joined = known.join(lead_of.select(*same, F.coalesce("component", "lead").alias("lead_in")), same, "left")
    component = F.coalesce("lead_in", "doc_id")
    linked = joined.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
    return linked.union(everything.filter("doc_id IS NULL").select("doc_id", "n_shingles", "doc_id", F.lit(True)))


def _regions(near: DataFrame, leads: DataFrame, found: DataFrame) -> DataFrame:
    """region, doc_id, side: the documents of every region of REST values that its reach cuts and that holds several components.

    One that is too large for a task is cut into blocks of half a task: a component that
    fills one has blocks of its own, the others share theirs. Every two blocks make a
    region of their own, whose sides 1 and 2 are to be compared; those of one component needn't.
    """
    names = near.filter("cut").select("tree", "short").distinct()
    orders = leads.mapInArrow(_orders, "tree int, key binary, doc_id long, n_shingles long").withColumn("short", F.substring("key", 1, 4 * REST)).drop("key")
    inside = orders.join(names, ["tree", "short"])
    inside = inside.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")).checkpoint()
    tasks = lambda n, size, half: F.greatest(F.ceil(n * half / REGION), F.ceil(size * half / REGION_SHINGLES)).cast("long")
    by = ["tree", "short"]
    parts = inside.groupBy(*by, "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size")).checkpoint()
    shapes = parts.groupBy(*by).agg(tasks(F.sum("n"), F.sum("size"), 1).alias("tasks"), F.count("*").alias("several")).filter("several > 1")
    whole = inside.join(shapes.filter("tasks = 1"), by).select(F.xxhash64(*by).alias("region"), "doc_id", F.lit(0).alias("side"))

    parts = parts.join(shapes.filter("tasks > 1"), by).withColumn("own", tasks(F.col("n"), F.col("size"), 2) > 1)
    parts = parts.select(*by, "component", "n", "size", "own", F.when(F.col("own"), F.col("component")).otherwise(0).alias("name"))
    blocks = parts.groupBy(*by, "own", "name").agg(tasks(F.sum("n"), F.sum("size"), 2).alias("blocks"))
    dealt = inside.join(parts.select(*by, "component", "own", "name"), [*by, "component"]).join(blocks, [*by, "own", "name"])
    dealt = dealt.select(*by, F.struct("own", "name", F.pmod(F.xxhash64("doc_id", "tree"), F.col("blocks")).alias("i")).alias("block"), "doc_id")
    each = blocks.select(*by, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("i"), "own", "name").select(*by, F.struct("own", "name", "i").alias("block"))
    pairs = each.withColumnRenamed("block", "left").join(each.withColumnRenamed("block", "right"), by).filter("left <= right AND NOT (left.own AND right.own AND left.name = right.name)")
    pairs = pairs.withColumn("region", F.xxhash64(*by, "left", "right")).withColumn("same", F.col("left") == F.col("right"))
    sides = pairs.select(*by, "region", F.col("left").alias("block"), F.when(F.col("same"), 0).otherwise(1).alias("side")).union(pairs.filter("NOT same").select(*by, "region", F.col("right").alias("block"), F.lit(2).alias("side")))
    return whole.union(dealt.join(sides, [*by, "block"]).select("region", "doc_id", "side")).checkpoint()


def _inside(regions: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b: each document and the smallest that it reaches by links inside its region, where these differ."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for a, b in tv.pieces(text):
                row, value = shingle_sets(*tv.strings(text.slice(a, b - a)), k)
                each = np.split(value, np.cumsum(np.bincount(row, minlength=b - a))[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array([x.tobytes() for x in each], pa.binary())], names=["doc_id", "hashes"])

    def reach(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        ids, side = table["doc_id"].to_numpy(), table["side"].to_numpy()
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        data, offsets = tv.strings(table["hashes"])
        n = np.diff(offsets) // 8
        _, column = np.unique(np.frombuffer(data.tobytes(), np.uint64), return_inverse=True)
        row = np.repeat(np.arange(len(ids)), n)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(left), len(right)), np.int32)
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            a, b = np.searchsorted(column, (first, first + 2048))
            holds = np.zeros((len(ids), 2048), np.float32)
            holds[row[a:b], column[a:b] - first] = 1
            both += (holds[left] @ holds[right].T).astype(np.int32)  # at most 2048 each, so exact
        linked = np.empty(both.shape, bool)
        for at in range(0, len(left), 256):
            same = both[at : at + 256].astype(np.int64)
            linked[at : at + 256] = 100 * same >= percent * (n[left[at : at + 256]][:, None] + n[right][None] - same)
        low = np.arange(len(ids))
        while True:
            new = low.copy()
            for own, other, links in ((left, right, linked), (right, left, linked.T)):
                new[own] = [low[other[x]].min(initial=at) for x, at in zip(links, new[own], strict=True)]
            new = new[new]
            if (new == low).all():
                break
            low = new
        out = np.flatnonzero(low != np.arange(len(ids)))
        del both, linked, row, column
        tv.release()
        return pa.table({"a": ids[low[out]], "b": ids[out]})

    ids = regions.select("doc_id").distinct()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    texts = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    rows = regions.join(texts.mapInArrow(sets, "doc_id long, hashes binary"), "doc_id")
    return rows.select("region", "doc_id", "side", "hashes").groupBy("region").applyInArrow(reach, "a long, b long").distinct()
