"""Connected components of an edge table, by alternating large-star and small-star steps.

Edges are first contracted inside their partitions, in bounded batches. Then each step
hangs the neighbours of a node on the smallest of them (Kiveris et al., "Connected
Components in MapReduce and Beyond"). Minima are aggregated before the shuffle and joined
back, so a node with very many neighbours isn't gathered in one place. Each round is cut
by a checkpoint in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minima(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))  # small-star takes repeats out


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minima(down)
    hung = down.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("u", F.col("m").alias("v"))).distinct()


#: Edges contracted at once.
BATCH = 1 << 20


def hung(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that it reaches) of all nodes that aren't the smallest themselves."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        np.minimum.at(new, low, new)
        new = new[new]
        if (new == low).all():
            break
        low = new
    some = np.flatnonzero(low != np.arange(len(low)))
    return nodes[some], nodes[low[some]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        u, v = hung(*(np.concatenate(x) for x in zip(*held, strict=True)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in ("u", "v")))
        if sum(len(x) for x, _ in held) >= BATCH:
            yield out()
    if held:
        yield out()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of edges(u long, v long).

    Loops and repeated edges do no harm; an empty table gives an empty one.
    """
    stars = edges.filter("u <> v").select("u", "v").mapInArrow(_contract, "u long, v long").distinct().checkpoint()
    state = None
    while True:
        stars = _small_star(_large_star(stars)).checkpoint()
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    loops = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(loops)


def lowest(linked: np.ndarray) -> np.ndarray:
    """The smallest index that each row of a symmetric matrix of links reaches."""
    low = np.arange(len(linked))
    while True:
        new = np.array([low[x].min(initial=at) for x, at in zip(linked, low, strict=True)], np.int64)
        new = new[new]
        if (new == low).all():
            return low
        low = new
