"""Queries of the pairing operators: F5 in passes, and its similarity join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pairing as op
from .adapters import table

C = F.col


def block_inputs(spark, sf):
    """Orders of a customer as blocks, odd ones ours, even ones theirs: line numbers and flags are events, the priority is the timing, the year the meter, the status the family."""
    lines = table(spark, sf, "lineitem").groupBy(C("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_set(F.concat_ws("/", "l_linenumber", "l_returnflag", C("l_quantity").cast("int") % 3))).alias("events"))
    rows = table(spark, sf, "orders").join(lines, "o_orderkey", "left").select(
        C("o_custkey").alias("cust"), C("o_orderstatus").alias("family"), C("o_orderkey").alias("block"), "events", C("o_orderpriority").alias("timing"), (F.year("o_orderdate") - 1990).alias("meter"),
    )
    return rows.filter("block % 2 = 1"), rows.filter("block % 2 = 0")


def pair_passes(spark, sf):
    return op.pair_passes(*block_inputs(spark, sf), ["cust"])


def similar_sets(spark, sf):
    """Odd and even orders of a customer and status that share at least half of their events."""
    ours, theirs = block_inputs(spark, sf)
    out = op.similar_sets(ours, theirs, ["cust", "family"])
    return out.select("cust", "family", "ours", "theirs", F.round("similarity", 6).alias("similarity"))


QUERIES = {"f5_pair_passes": pair_passes, "f5_similar_sets": similar_sets}

SQL = {
    "f5_similar_sets": """WITH b AS (SELECT o_custkey AS cust, o_orderstatus AS family, o_orderkey AS block, list_sort(list_distinct(list(l_linenumber || '/' || l_returnflag || '/' || CAST(trunc(l_quantity) AS INTEGER) % 3))) AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
        p AS (SELECT a.cust, a.family, a.block AS ours, b.block AS theirs, len(list_intersect(a.e, b.e)) AS n, len(a.e) + len(b.e) AS m FROM b a JOIN b ON a.cust = b.cust AND a.family = b.family WHERE a.block % 2 = 1 AND b.block % 2 = 0)
        SELECT cust, family, ours, theirs, round(n / (m - n), 6) AS similarity FROM p WHERE 2 * n >= m - n""",
}
