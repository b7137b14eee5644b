"""Queries of the gate: I11 and I12 in full, and I13's packets drawn in one cycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grading as op
from ..operators._range import numbered
from .adapters import table

C = F.col
NAMES = ("part", "line", "flag", "supplier", "size")


def grade_inputs(spark, sf):
    """Orders as charts, every tenth as a catalog chart, their lines as holds; every third order has an upstream block without its returned lines; parts of one brand and order are clusters."""
    lines = table(spark, sf, "lineitem").select(
        C("l_orderkey").alias("chart"), (C("l_partkey") % 4).alias("part"), (C("l_linenumber") % 3).alias("line"), F.when(C("l_returnflag") == "R", 0).when(C("l_returnflag") == "A", 1).otherwise(2).alias("flag"),
        (C("l_suppkey") % 3).alias("supplier"), F.floor(C("l_quantity") / 10).alias("size"),
    )
    kind = F.when(C("chart") % 10 == 0, "k").otherwise("c")
    cluster = F.when((kind == "c") & (C("part") < 2), C("chart") * 2 + C("part"))
    holds = lines.select(kind.alias("kind"), "chart", cluster.alias("cluster"), *NAMES).union(lines.filter("chart % 10 <> 0 AND chart % 3 = 0 AND flag > 0").select(F.lit("u"), "chart", F.lit(None).cast("long"), *NAMES))
    n = lines.groupBy("chart").agg(F.count("*").alias("base"), F.count_if(C("flag") > 0).alias("up"))
    split = F.when(C("chart") % 7 < 5, "tune").otherwise("sealed").alias("split")
    off = F.when(C("chart") % 3 == 1, 1).when(C("chart") % 8 == 0, 2).otherwise(0)
    charts = n.filter("chart % 10 <> 0").select("chart", split, (C("chart") % 4 == 1).alias("pristine"), "base", (C("base") + off).alias("expected"), F.when(C("chart") % 3 == 0, C("up")).alias("up_base"), (C("chart") % 2 == 0).alias("noted"), (C("chart") % 5).alias("pack"))
    catalog = n.filter("chart % 10 = 0").select("chart", split, C("base").alias("expected"))
    clusters = lines.filter("chart % 10 <> 0 AND part < 2").groupBy((C("chart") * 2 + C("part")).alias("cluster"), "chart").agg(F.count("*").alias("ticks")).select("cluster", split, "ticks", (C("ticks") + F.when(C("cluster") % 3 == 0, 1).otherwise(0)).alias("price"))
    return holds, charts, catalog, clusters


def null_gate(spark, sf):
    """All rules of one and two features and two hundred of three, plus and minus one event, through the gate."""
    holds, charts, catalog, clusters = grade_inputs(spark, sf)
    return op.null_gate(holds, NAMES, charts, catalog, clusters, 200, "seed")


def grade_rule(spark, sf):
    """One rule in all its counts: a returned line counts once more in orders of which at most one line is returned."""
    holds, charts, catalog, clusters = grade_inputs(spark, sf)
    more = holds.groupBy("kind", "chart").agg(F.count_if(C("flag") == 0).alias("n")).filter("n = 1")
    of = lambda kind, out: more.filter(C("kind") == kind).select("chart", C("n").alias(out))
    name = F.lit("returned").alias("rule")
    rows = charts.join(of("c", "_c"), "chart", "left").join(of("u", "_u"), "chart", "left").select(name, "*", (C("base") + F.coalesce("_c", F.lit(0))).alias("variant"), (C("up_base") + F.coalesce("_u", F.lit(0))).alias("up_variant"))
    listed = catalog.join(of("k", "_k"), "chart", "left").select(name, "*", (C("expected") + F.coalesce("_k", F.lit(0))).alias("variant"))
    hit = holds.filter("kind = 'c' AND flag = 0 AND cluster IS NOT NULL").join(more.filter("kind = 'c'").select("chart"), "chart", "left_semi").groupBy("cluster").agg(F.count("*").alias("_n"))
    held = clusters.join(hit, "cluster", "left").select(name, "*", (C("ticks") + F.coalesce("_n", F.lit(0))).alias("variant"))
    return op.gate(rows, listed, held, ["rule"])


def draw_packets(spark, sf):
    """All documents in packets, with orders of the highest priority as seeds, in order of a hash."""
    items = numbered(table(spark, sf, "documents").select(C("doc_id").alias("item")), ["item"], "pos")
    seeds = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(C("o_orderkey").alias("seed"), F.sha2(F.concat(F.lit("salt|"), C("o_orderkey").cast("string")), 256).alias("_h"))
    return op.draw_packets(items, numbered(seeds, ["_h", "seed"], "n").drop("_h"), "salt", most_packets=None)


QUERIES = {"i11_gate": grade_rule, "i12_null_gate": null_gate, "i13_draw_packets": draw_packets}

SQL = {
    "i11_gate": """WITH l AS (SELECT l_orderkey AS chart, l_partkey % 4 AS part, l_returnflag = 'R' AS r FROM lineitem), n AS (SELECT chart, count(*) AS base, count(*) FILTER (NOT r) AS up, count(*) FILTER (r) AS k FROM l GROUP BY 1),
        s AS (SELECT *, CASE WHEN chart % 7 < 5 THEN 'tune' ELSE 'sealed' END AS split, base + CASE WHEN k = 1 THEN 1 ELSE 0 END AS v FROM n),
        c AS (SELECT *, base + CASE WHEN chart % 3 = 1 THEN 1 WHEN chart % 8 = 0 THEN 2 ELSE 0 END AS e, chart % 4 = 1 AS p, CASE WHEN chart % 3 = 0 THEN up END AS ub FROM s WHERE chart % 10 <> 0),
        g AS (SELECT unnest([split, 'whole']) AS scope, base = e AS was, v = e AS now, v, base, e, p, ub, coalesce(ub = e, false) AS x, chart FROM c),
        a AS (SELECT scope, 0 AS errors, count(*) FILTER (v <> base) AS touched, count(*) FILTER (was AND NOT now AND p) AS pristine_breaks, count(*) FILTER (was AND NOT now AND NOT p AND NOT x) AS fitted_breaks, count(*) FILTER (was AND NOT now AND NOT p AND x) AS excused_breaks, count(*) FILTER (NOT was AND now) AS fixes,
              count(*) FILTER (NOT was AND now AND chart % 2 = 0) AS noted_fixes, count(DISTINCT chart % 5) FILTER (NOT was AND now AND chart % 2 = 0) AS noted_packs, count(*) FILTER (NOT was AND NOT now AND abs(v - e) < abs(base - e)) AS better, count(*) FILTER (NOT was AND NOT now AND abs(v - e) > abs(base - e)) AS worse, count(*) FILTER (NOT p AND ub <> e AND x) AS upstream_exact FROM g GROUP BY 1),
        b AS (SELECT unnest([split, 'whole']) AS scope, v <> base AS bad FROM s WHERE chart % 10 = 0), k AS (SELECT scope, count(*) FILTER (bad) AS catalog_breaks FROM b GROUP BY 1),
        t AS (SELECT l.chart, chart * 2 + part AS cluster, count(*) AS ticks, count(*) FILTER (r AND n.k = 1) AS more FROM l JOIN n USING (chart) WHERE chart % 10 <> 0 AND part < 2 GROUP BY ALL),
        u AS (SELECT unnest([CASE WHEN chart % 7 < 5 THEN 'tune' ELSE 'sealed' END, 'whole']) AS scope, cluster % 3 <> 0 AS was, more = CASE WHEN cluster % 3 = 0 THEN 1 ELSE 0 END AS now FROM t),
        h AS (SELECT scope, count(*) FILTER (was AND NOT now) AS clusters_lost, count(*) FILTER (NOT was AND now) AS clusters_gained FROM u GROUP BY 1)
        SELECT 'returned' AS rule, a.*, catalog_breaks, clusters_lost, clusters_gained, fixes - pristine_breaks - fitted_breaks - excused_breaks AS net FROM a JOIN k USING (scope) JOIN h USING (scope)""",
    "i13_draw_packets": """WITH p AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 19 AS packet, 'real' AS kind, doc_id::VARCHAR AS item FROM documents), s AS (SELECT o_orderkey::VARCHAR AS item, row_number() OVER (ORDER BY sha256('salt|' || o_orderkey), o_orderkey) - 1 AS n FROM orders WHERE o_orderpriority = '1-URGENT'),
        z AS (SELECT packet, unnest(range(least(greatest(1, CAST(ceil(count(*) * 0.25) AS BIGINT)), (SELECT count(*) FROM s)))) AS j FROM p GROUP BY packet),
        u AS (SELECT * FROM p UNION ALL SELECT packet, 'seed', s.item FROM z JOIN s ON s.n = (packet * 5 + j) % (SELECT count(*) FROM s)), i AS (SELECT *, substr(sha256('salt|' || packet || '|' || kind || '|' || item), 1, 16) AS iid FROM u)
        SELECT packet, row_number() OVER (PARTITION BY packet ORDER BY iid) AS slot, iid, kind, item FROM i""",
}
