"""Embedding near-deduplication by sorted projection passes.

In each pass every vector gets the signs of `BITS` random projections as one code and
the vectors of a label are ordered by code. What is ordered is small: the code and a
sketch of 128 more signs. A vector whose sketch comes close to that of one of about
`window` neighbours is a candidate, and only for candidates are vectors fetched, once
for each block of neighbours, and compared in double precision. Neighbours lie on both
sides of the edges of partitions too. Links are united over all passes; after the
first few passes, vectors of one component are no longer candidates.

As all links of a vector lie in its component, links are counted there at the end:
each component is compared whole, in one task or, if it is too large for that, in one
for every two of its blocks. So the count doesn't depend on which pass met which pair,
no pairs leave a task, and a dense run needs no more than the chain of its neighbours.
Equal vectors are one class; only its smallest vec_id is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, lowest

BITS, SKETCH = 48, 128
#: The fewest passes, and the share of pairs at the least cosine that some pass is to bring within a window.
PASSES, RECALL = 20, 0.9999
#: Passes before the first uniting.
FIRST = 5
#: Vectors of a component that a task compares whole; the least and the most of one of the blocks of a larger one, a quarter of it between these.
WHOLE, BLOCK, MOST_BLOCK = 512, 256, 4096
#: Vectors projected at once.
SLICE = 2048

ORDERED = "grp long, code long, vec_id long, s0 long, s1 long, component long"
MARKED = "kind int, part int, at long, n long, key long, " + ORDERED


def passes_for(n: int, least: float, window: int) -> int:
    """Passes for labels of up to n vectors whose codes are spread evenly.

    A pair is within a window if it shares the bits that cut n to windows; it shares one with probability 1 - angle / pi.
    """
    bits = math.ceil(math.log2(max(1, n / window)))
    met = (1 - math.acos(least) / math.pi) ** bits
    return PASSES if met == 1 else max(PASSES, math.ceil(math.log(1 - RECALL) / math.log1p(-met)))


def most_bits(least: float) -> int:
    """Bits of the sketch that a pair at the least cosine differs in, and four deviations more."""
    p = math.acos(least) / math.pi
    return math.ceil(SKETCH * p + 4 * math.sqrt(SKETCH * p * (1 - p)))


def units(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one dimension, of length 1, in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    unit = flat / np.abs(flat).max(1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def _by_dim(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.asarray(batch.column("dim"))
    for dim in np.unique(sizes).tolist():
        yield dim, np.flatnonzero(sizes == dim)


def _words(signs: np.ndarray) -> np.ndarray:
    """Rows of signs as one long."""
    return signs @ (np.uint64(1) << np.arange(signs.shape[1], dtype=np.uint64)[::-1])


def _codes(passes: range, seed: int):
    """One row in ORDERED for each vector and pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.slice(at, SLICE)
                for dim, rows in _by_dim(batch):
                    part = batch.take(pa.array(rows))
                    if dim not in planes:
                        sizes = [(SKETCH, -1), *((BITS, p) for p in passes)]
                        planes[dim] = np.concatenate([np.random.default_rng([seed, dim, p + 1]).standard_normal((dim, k)) for k, p in sizes], axis=1)
                    signs = (units(part.column("embedding"), dim) @ planes[dim] > 0).astype(np.uint64)
                    sketch = [pa.array(_words(signs[:, k : k + 64]).view(np.int64)) for k in (0, 64)]
                    group = part.column("grp").to_numpy().astype(np.uint64)
                    for k, p in enumerate(passes):
                        code = _words(signs[:, SKETCH + k * BITS : SKETCH + (k + 1) * BITS]).view(np.int64)
                        grp = (group ^ np.uint64((p + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(grp), pa.array(code), part.column("vec_id"), *sketch, part.column("component")], names=["grp", "code", "vec_id", "s0", "s1", "component"])

    return run


class _Rows:
    """Rows in ORDERED as arrays."""

    NAMES = ("grp", "code", "vec_id", "s0", "s1", "component")

    def __init__(self, *columns: np.ndarray):
        self.columns = columns

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table) -> _Rows:
        return cls(*(np.asarray(batch.column(c)).astype(np.int64) for c in cls.NAMES))

    def __len__(self) -> int:
        return len(self.columns[0])

    def __getitem__(self, where) -> _Rows:
        return _Rows(*(c[where] for c in self.columns))

    def __add__(self, other: _Rows) -> _Rows:
        return _Rows(*(np.concatenate(x) for x in zip(self.columns, other.columns, strict=True)))

    def close(self, other: _Rows, most: int) -> np.ndarray:
        """Which rows are candidates of which others."""
        grp, _, _, s0, s1, component = (x[:, None] for x in self.columns)
        grp2, _, _, t0, t1, component2 = other.columns
        apart = np.bitwise_count((s0 ^ t0).view(np.uint64)) + np.bitwise_count((s1 ^ t1).view(np.uint64))
        return (apart <= most) & (grp == grp2) & (component != component2)

    def marked(self, kind: int, part: int, at, n: int, key) -> pa.RecordBatch:
        size = len(self)
        fill = lambda x, t: pa.array(np.broadcast_to(np.asarray(x, t), size))
        return pa.RecordBatch.from_arrays([fill(kind, np.int32), fill(part, np.int32), fill(at, np.int64), fill(n, np.int64), fill(key, np.int64), *map(pa.array, self.columns)], names=["kind", "part", "at", "n", "key", *self.NAMES])


def _candidates(own: _Rows, before: _Rows, most: int, inside: bool) -> _Rows:
    """The rows of both that are candidates of own ones."""
    there = own.close(before, most)
    mine, theirs = there.any(1), there.any(0)
    if inside:
        mine |= own.close(own, most).any(1)
    return own[mine] + before[theirs]


def _neighbours(window: int, most: int):
    """From rows in order: the candidates of each block (kind 0), and the first and last rows of the partition (kinds 1, 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, head = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            rows = _Rows.of(batch)
            for at in range(0, len(rows), window):
                own = rows[at : at + window]
                before = own[:0] if held is None else held
                found = _candidates(own, before, most, inside=True)
                if len(found):
                    yield found.marked(0, part, 0, 0, (part << 40) + n)
                if n < window:
                    head = own if head is None else (head + own)[:window]
                n += len(own)
                held = (before + own)[-window:]
        if n:
            yield head.marked(1, part, np.arange(len(head)), n, 0)
            yield held.marked(2, part, np.arange(n - len(held), n), n, 0)

    return run


def _over_edges(most: int):
    """The candidates among the last rows before an edge of partitions and the first after it."""

    def run(table: pa.Table) -> pa.Table:
        rows, kind = _Rows.of(table), np.asarray(table["kind"])
        found = _candidates(rows[kind == 1], rows[kind == 2], most, inside=False)
        return pa.table({"key": pa.array(np.full(len(found), -1 - table["edge"][0].as_py())), "vec_id": pa.array(found.columns[2])})

    return run


def _edges(rows: DataFrame, window: int) -> DataFrame:
    """edge, and the rows within `window` of it on either side; a partition of few rows has rows at several edges."""
    sizes = [(r.part, r.n) for r in rows.filter("kind = 1 AND at = 0").select("part", "n").orderBy("part").collect()]  # one for each partition
    uses = []
    for i, (part, _) in enumerate(sizes):
        want, k = window, i - 1
        while want > 0 and k >= 0:
            uses.append((sizes[k][0], part, sizes[k][1] - want))
            want, k = want - sizes[k][1], k - 1
    tails = rows.sparkSession.createDataFrame(uses, "part int, edge int, least long")
    last = rows.filter("kind = 2").join(tails, "part").filter("at >= least").drop("least")
    return last.unionByName(rows.filter("kind = 1").withColumn("edge", F.col("part")))


def _verify(least: float):
    """a, b: each vector of a block and the smallest that it reaches there by links, where these differ."""

    def run(table: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        table = table.sort_by("vec_id").combine_chunks()
        labels = np.asarray(table["label"].combine_chunks().dictionary_encode().indices)
        for dim, rows in _by_dim(table):
            unit, ids = units(table["embedding"].combine_chunks().take(pa.array(rows)), dim), table["vec_id"].to_numpy()[rows]
            low = lowest((unit @ unit.T >= least) & (labels[rows][:, None] == labels[rows]))
            some = np.flatnonzero(low != np.arange(len(low)))
            out.append((ids[low[some]], ids[some]))
        a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"a": a, "b": b})

    return run


def _united(leads: DataFrame, found: DataFrame | None, passes: range, least: float, window: int, seed: int) -> DataFrame:
    """a, b: links that join components of `found`, as far as these passes meet them."""
    if found is None:
        rows = leads.withColumn("component", F.col("vec_id"))
    else:
        rows = leads.join(found.withColumnRenamed("node", "vec_id"), "vec_id", "left").withColumn("component", F.coalesce("component", "vec_id"))
    rows = rows.select("vec_id", "embedding", "dim", F.xxhash64("label", "dim").alias("grp"), "component")
    order, most = ["grp", "code", "vec_id"], most_bits(least)
    ordered = rows.mapInArrow(_codes(passes, seed), ORDERED).repartitionByRange(*order).sortWithinPartitions(*order)
    near = ordered.mapInArrow(_neighbours(window, most), MARKED).checkpoint()
    over = _edges(near, window).groupBy("edge").applyInArrow(_over_edges(most), "key long, vec_id long")
    marks = near.filter("kind = 0").select("key", "vec_id").union(over).distinct()
    blocks = marks.join(leads.select("vec_id", "label", "dim", "embedding"), "vec_id").select("key", "vec_id", F.col("label").cast("string").alias("label"), "dim", "embedding")
    return blocks.groupBy("key").applyInArrow(_verify(least), "a long, b long").distinct()


def _count(least: float):
    """For each vector of a region the vectors of the other side (of its own, if there is one only) that it links with."""

    def run(table: pa.Table) -> pa.Table:
        ids, side, n = (table[c].to_numpy() for c in ("vec_id", "side", "n"))
        unit = units(table["embedding"].combine_chunks(), table["dim"][0].as_py())  # a component has one label and one dimension
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        linked = unit[left] @ unit[right].T >= least
        if not side.any():
            np.fill_diagonal(linked, False)
            return pa.table({"vec_id": ids, "others": linked @ n})
        return pa.table({"vec_id": np.concatenate((ids[left], ids[right])), "others": np.concatenate((linked @ n[right], n[left] @ linked))})

    return run


def _counted(leads: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """vec_id, others: how many vectors of other classes each lead of a component links with."""
    inside = found.withColumnRenamed("node", "vec_id").join(leads.select("vec_id", "n", "dim", "embedding"), "vec_id")
    block = F.least(F.greatest(F.ceil(F.col("size") / 4), F.lit(BLOCK)), F.lit(MOST_BLOCK))
    blocks = F.when(F.col("size") <= WHOLE, 1).otherwise(F.ceil(F.col("size") / block)).cast("int").alias("blocks")
    sizes = found.groupBy("component").agg(F.count("*").alias("size")).select("component", blocks)
    dealt = inside.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))  # a vector goes to each pair of blocks that its own is in
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side")
    regions = dealt.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "vec_id", side, "n", "dim", "embedding")
    parts = regions.groupBy("component", "i", "j").applyInArrow(_count(least), "vec_id long, others long")
    return parts.groupBy("vec_id").agg(F.sum("others").alias("others"))


def near_vectors(vectors: DataFrame, least: float = 0.93, passes: int | None = None, window: int = 256, seed: int = 7) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable), kept (vec_id = component_id).

    Vectors link if their labels (of any atomic type) are equal and not null, their
    dimensions are equal and their cosine is at least `least`. A vector that is null,
    empty, zero, or holds a null or non-finite component links with nothing and is
    kept. vec_id is taken to be a key: rows that repeat one with equal vectors count as
    vectors of their own, with different ones the result is undefined; a row whose
    vec_id is null is left out of the links and is kept, with null as its component.
    Equal vectors link with each other. Passes that aren't given follow from the largest
    label. An empty table gives an empty one; other columns are ignored.
    """
    rows = vectors.select("vec_id", "label", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    good = rows.filter(fit)
    key = ["label", "print"]  # 128 bits tell vectors apart
    members = good.select("vec_id", "label", F.struct(F.xxhash64("embedding"), F.xxhash64(F.reverse("embedding"), F.lit(1))).alias("print"))
    classes = members.groupBy(*key).agg(F.min("vec_id").alias("lead"), F.count("*").alias("n")).checkpoint()
    first = classes.groupBy(F.col("lead").alias("vec_id")).agg(F.max("n").alias("n"))
    leads = good.join(first, "vec_id").select("vec_id", "n", "label", F.size("embedding").alias("dim"), F.col("embedding").cast("array<double>").alias("embedding")).dropDuplicates(["vec_id"]).checkpoint()
    if passes is None:
        largest = leads.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
        passes = passes_for(largest, least, window)
    found = None
    for some in (range(0, min(FIRST, passes)), range(FIRST, passes)):
        more = _united(leads, found, some, least, window, seed).toDF("u", "v").checkpoint()
        if found is None:
            found = components(more).checkpoint()
        elif not more.isEmpty():
            found = components(found.toDF("u", "v").union(more)).checkpoint()
    counted = _counted(leads, found, least)
    of = classes.join(counted.withColumnRenamed("vec_id", "lead"), "lead", "left").join(found.withColumnRenamed("node", "lead"), "lead", "left")
    of = of.select(*key, (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "lead").alias("component_id"))
    linked = members.join(of, key).select("vec_id", "n_links", "component_id")
    single = rows.filter(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(single).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
