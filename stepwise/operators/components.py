"""Connected components of an edge table: every node is hung on ever smaller ones until only stars are left.

One round takes two steps. In the first, each node hands its larger neighbours to the
smallest node that it knows; in the second, its smaller ones and itself. Paths shrink
by about half a round, and minima are aggregated before they are joined back, so a
node with very many neighbours is never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _hang(pairs: DataFrame, larger: bool) -> DataFrame:
    """(child, parent) after one step over pairs(u, v), in which every edge stands from the side that hands it on."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = pairs.join(least, "u").filter("v > u" if larger else "v > m").select(F.col("v").alias("child"), F.col("m").alias("parent"))
    return moved.distinct() if larger else moved.union(least.select("u", "m")).filter("child <> parent").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for all nodes of edges(u, v); loops and repeated edges do no harm."""
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    tree = edges.filter("u <> v").select(F.greatest("u", "v").alias("child"), F.least("u", "v").alias("parent")).distinct().checkpoint()
    state = None
    while True:
        both = tree.select(F.col("child").alias("u"), F.col("parent").alias("v"))
        tree = _hang(both.union(both.select("v", "u")), larger=True)
        tree = _hang(tree.select(F.col("child").alias("u"), F.col("parent").alias("v")), larger=False).checkpoint()
        now = tree.agg(F.count("*"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    found = tree.select(F.col("child").alias("node"), F.col("parent").alias("component"))
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
