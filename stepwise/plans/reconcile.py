"""Queries G1 to G19."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reconcile as op
from .adapters import EVENTS, HOUR, SPANS, events, spans, table

BY = ["series"]
C = F.col


def implied_totals(spark, sf):
    """Blocks are orders: rows are line numbers, hold events the quantities of returned lines; orders of priority 5 have an error."""
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    blocks = table(spark, sf, "orders").select("o_orderkey", F.when(C("o_orderpriority") == "5-LOW", "unreadable").alias("error"))
    holds = lines.filter("l_returnflag = 'R'").select("o_orderkey", C("l_quantity").cast("long").alias("events"))
    return op.implied_totals(lines.select("o_orderkey", C("l_linenumber").alias("beat")), holds, blocks, ["o_orderkey"])


def _swept(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(C("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("implied"), F.countDistinct("l_suppkey").alias("regions"), F.sum(F.when(C("l_returnflag") == "R", 1).otherwise(0)).alias("hold_events"))
    rows = lines.select("*", F.when(C("o_orderkey") % 9 != 0, C("o_orderkey") % 7 + 1).alias("count1"), F.when(C("o_orderkey") % 4 != 0, C("o_orderkey") % 5 + 1).alias("count2"), (C("o_orderkey") % 11 + 0).alias("m"))
    rows = rows.withColumn("blocks_alike", F.when(C("m") == 0, 2).otherwise(1)).drop("m")
    return op.sweep(rows, 30)


def sweep(spark, sf):
    return _swept(spark, sf).select("o_orderkey", "delta", "pct", "verdict", "shape")


def sweep_counts(spark, sf):
    return op.tally(_swept(spark, sf), "verdict", "shape")


def observe_holds(spark, sf):
    anchors = events(spark, sf, "purchase").select("series", "t", C("v").alias("cum"))
    regions = spans(spark, sf, "click", 1).select("series", C("id").alias("region"), "s", "e")
    out = op.observe_holds(anchors, events(spark, sf, "error"), regions, BY)
    return out.select("series", "region", C("lo").cast("long").alias("lo"), C("hi").cast("long").alias("hi"), "events", "pinned")


def slack_screen(spark, sf):
    anchors = events(spark, sf, "purchase").select("series", "t", (C("v") % 40 - 35).alias("cum"))
    return op.slack_screen(anchors, events(spark, sf, "click"), BY, 48 * HOUR)


def run_drift(spark, sf):
    runs = events(spark, sf).withColumn("run", F.floor(C("t") / (96 * HOUR)))
    holds = spans(spark, sf, "view", 4).select("series", C("s").alias("ps"), C("e").alias("pe"))
    return op.run_drift(runs, events(spark, sf, "click"), holds, BY, 48 * HOUR, lag=HOUR)


def excess_clusters(spark, sf):
    return op.excess_clusters(events(spark, sf).withColumn("v", C("v") % 10), events(spark, sf, "click"), BY, 20 * HOUR, 24 * HOUR, 3, HOUR)


def deficit_segments(spark, sf):
    reads = events(spark, sf).withColumn("v", C("v") % 3)
    return op.deficit_segments(reads, events(spark, sf, "click"), BY, HOUR, HOUR)


def judge_stretches(spark, sf):
    points = op.quiet_points(events(spark, sf).withColumn("v", C("v") % 6), BY, 24 * HOUR)
    holds = spans(spark, sf, "view", 4).select("series", C("s").alias("ps"), C("e").alias("pe"))
    return op.judge_stretches(points, events(spark, sf, "click"), holds, BY, 48 * HOUR)


def price_clusters(spark, sf):
    regions = spans(spark, sf, "view", 1).select("series", "s", "e", (C("id") % 50).alias("ticks"))
    readings = events(spark, sf, "purchase").groupBy("series", "t").agg(F.max("v").alias("error")).withColumn("run", F.floor(C("t") / (240 * HOUR)))
    return op.price_clusters(regions, readings, BY, 40 * HOUR).drop("cluster")


def price_rails(spark, sf):
    rails = spans(spark, sf, "view", 5).select("series", "s", "e")
    resets = events(spark, sf, "signup").filter("k < 30").select("series", "t")
    return op.price_rails(rails, events(spark, sf, "purchase"), events(spark, sf, "click"), resets, BY, 0)


def _lines(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("long").alias("weight"), F.min("l_partkey").alias("p"))
    orders = table(spark, sf, "orders").select(C("o_orderkey").alias("l_orderkey"), F.round(C("o_totalprice") * 100).cast("long").alias("total"))
    return lines.join(orders, "l_orderkey").withColumnRenamed("l_linenumber", "item")


def allocate(spark, sf):
    """An order's cents over its lines by quantity, exactly."""
    return op.allocate(_lines(spark, sf), ["l_orderkey"]).select("l_orderkey", "item", "share")


def allocate_pinned(spark, sf):
    """The same with every fifth part pinned at 1000 cents; the largest takes what rounding leaves."""
    rows = _lines(spark, sf).withColumn("pin", F.when(C("p") % 5 == 0, 1000).cast("long"))
    return op.allocate(rows, ["l_orderkey"], pinned="pin", method="largest").select("l_orderkey", "item", "share")


def solve_counts(spark, sf):
    """Orders with lines as regions: each line's row sees it and half of the next."""
    lines = _lines(spark, sf).select("l_orderkey", C("item").cast("long").alias("region"), "weight")
    own = lines.select("l_orderkey", C("region").alias("row"), "region", F.lit(1.0).alias("share"), C("weight").cast("double").alias("value"))
    half = own.select("l_orderkey", "row", (C("region") + 1).alias("region"), F.lit(0.5).alias("share"), "value").join(lines.groupBy("l_orderkey").agg(F.max("region").alias("last")), "l_orderkey").filter("region <= last").select(*own.columns)
    return op.solve_counts(own.unionByName(half), lines.groupBy("l_orderkey").agg(F.sum("weight").alias("total")), ["l_orderkey"]).select("l_orderkey", "region", "count")


def raise_floors(spark, sf):
    rows = _lines(spark, sf).select("l_orderkey", C("item").cast("long").alias("region"), C("item").cast("double").alias("t"), C("weight").alias("target"), F.lit(8).cast("long").alias("floor"))
    return op.raise_floors(rows, ["l_orderkey"])


def search_rates(spark, sf):
    rows = events(spark, sf, "view").select(C("id").alias("key"), (C("v") * 3).alias("head"), (C("v") * 3 + C("k") * 12 + 1).alias("tail"), (C("k") % 7 + 1).alias("rate"), (C("k") * 2 + C("v") % 9).alias("target"))
    rates = spark.range(1, 33).select(C("id").alias("candidate"))
    return op.search_rates(rows, rates, 12).select("key", "new_rate")


def audit_regions(spark, sf):
    regions = spans(spark, sf, "view", 1).select("series", C("id").alias("region"), C("s"), (C("e") + 72 * HOUR).alias("e"), (C("id") % 50).alias("ticks"))
    anchors = events(spark, sf, "purchase").select("series", "t", C("v").alias("cum"))
    return op.audit_regions(_apart(regions), anchors, events(spark, sf, "click"), BY, 1, 0.2)


def _apart(regions):
    """Regions cut short where the next one starts."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("series").orderBy("s")
    return regions.withColumn("e", F.least(C("e"), F.coalesce(F.lead("s").over(order) - 1, C("e"))))


def verdict_ladder(spark, sf):
    rules = [(C("o_orderstatus") == "F", "SHIP", "finished"), (C("o_totalprice") < 50_000, "PARK", "small"), (C("o_orderpriority").like("1%"), "SHIP", "urgent"), (C("o_totalprice") > 400_000, "PARK", "large")]
    return op.verdict_ladder(table(spark, sf, "orders"), rules).select("o_orderkey", "verdict", "reason")


def closer(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("ours"))
    rows = lines.select("l_orderkey", "ours", F.when(C("l_orderkey") % 8 != 0, C("l_orderkey") % 6).alias("theirs"), F.when(C("l_orderkey") % 10 != 0, C("l_orderkey") % 7).alias("ref"))
    return op.closer(rows).select("l_orderkey", "verdict", "gain", "rank")


def worklist(spark, sf):
    """Each customer's orders whose line count misses a target by over one, nearest first, at most five named."""
    lines = table(spark, sf, "lineitem").groupBy(C("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(lines, "o_orderkey").withColumn("miss", F.abs(C("n_lines") - C("o_orderkey") % 7))
    out = op.worklist(rows, "o_custkey", "o_orderkey", C("miss") > 1, [C("o_custkey")], [C("miss"), C("o_orderkey")], 5)
    return out.select("o_custkey", "n", F.array_join("names", ",").alias("names"))


def derive_manifest(spark, sf):
    k = C("o_orderkey")
    rows = table(spark, sf, "orders").select(k.alias("chart"), (k % 3 == 0).alias("was_exact"), F.concat("o_orderstatus", (k % 4).cast("string")).alias("sha"), (k % 5 < 2).alias("exact"))
    return op.derive_manifest(rows.select("chart", "was_exact"), rows.select("chart", C("sha")), rows.filter("chart % 13 <> 0").select("chart", F.when(C("chart") % 6 == 0, "edited").otherwise(C("sha")).alias("sha"), "exact"))


QUERIES = {
    "g1_implied_totals": implied_totals, "g2_sweep": sweep, "g2_sweep_counts": sweep_counts, "g3_observe_holds": observe_holds, "g4_slack_screen": slack_screen, "g5_run_drift": run_drift, "g6_excess_clusters": excess_clusters,
    "g7_deficit_segments": deficit_segments, "g8_judge_stretches": judge_stretches, "g9_price_clusters": price_clusters, "g10_price_rails": price_rails, "g11_allocate": allocate, "g11_allocate_pinned": allocate_pinned,
    "g12_solve_counts": solve_counts, "g13_raise_floors": raise_floors, "g14_search_rates": search_rates, "g15_audit_regions": audit_regions, "g16_verdict_ladder": verdict_ladder, "g17_closer": closer, "g18_worklist": worklist, "g19_derive_manifest": derive_manifest,
}

_SWEPT = "l AS (SELECT l_orderkey AS o, count(*) AS i, count(DISTINCT l_suppkey) AS r, count(*) FILTER (l_returnflag = 'R') AS h FROM lineitem GROUP BY 1), c AS (SELECT *, CASE WHEN o % 9 <> 0 THEN o % 7 + 1 END AS c1, CASE WHEN o % 4 <> 0 THEN o % 5 + 1 END AS c2 FROM l), n AS (SELECT *, coalesce(c1, c2) AS base, CASE WHEN c1 IS NULL AND c2 IS NULL THEN 'no_count' WHEN coalesce(i = c1, false) OR coalesce(i = c2, false) THEN 'exact' ELSE 'off' END AS verdict FROM c), d AS (SELECT *, CASE WHEN verdict = 'off' THEN i - base END AS delta FROM n), s AS (SELECT o AS o_orderkey, delta, round(100 * delta / base, 1) AS pct, verdict, CASE WHEN verdict <> 'off' THEN NULL WHEN o % 11 = 0 THEN 'duplicate_block' WHEN h = 0 THEN 'hold_less' WHEN r = 1 THEN 'single_region' WHEN delta > 0 THEN 'over_ticked' ELSE 'under_ticked' END AS shape FROM d), swept AS (SELECT * FROM s WHERE verdict <> 'off' OR abs(pct) > 30)"
_ALLOC = "i AS (SELECT l_orderkey, l_linenumber AS item, CAST(max(l_quantity) AS BIGINT) AS weight, min(l_partkey) AS p FROM lineitem GROUP BY ALL), r AS (SELECT i.*, CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM i JOIN orders ON l_orderkey = o_orderkey)"

SQL = {
    "g1_implied_totals": "WITH t AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS taps, CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS h FROM lineitem GROUP BY 1) SELECT o_orderkey, CASE WHEN bad THEN NULL ELSE coalesce(taps, 0) END AS taps, CASE WHEN bad THEN NULL ELSE coalesce(h, 0) END AS hold_events, CASE WHEN bad THEN NULL ELSE coalesce(taps, 0) + coalesce(h, 0) END AS implied, CASE WHEN bad THEN 'unreadable' ELSE 'ok' END AS status FROM (SELECT o_orderkey, o_orderpriority = '5-LOW' AS bad FROM orders) LEFT JOIN t ON o_orderkey = l_orderkey",
    "g2_sweep": f"WITH {_SWEPT} SELECT * FROM swept",
    "g2_sweep_counts": f"WITH {_SWEPT} SELECT 'verdict' AS column, verdict AS value, count(*) AS n FROM swept GROUP BY verdict UNION ALL SELECT 'shape', shape, count(*) FROM swept GROUP BY shape".replace("AS column", 'AS "column"'),
    "g3_observe_holds": f"""WITH {EVENTS}, {SPANS('w', 'click', 1)}, r AS (SELECT series, id, coalesce((lag(e) OVER x + s) / 2, s) AS lo, coalesce((e + lead(s) OVER x) / 2, e) AS hi FROM w WINDOW x AS (PARTITION BY series ORDER BY s)),
        a AS (SELECT series, t, max(v) AS cum FROM events_ WHERE kind = 'purchase' GROUP BY ALL), p AS (SELECT r.*, a.t AS t0, a.cum AS c0 FROM r ASOF LEFT JOIN a ON r.series = a.series AND r.lo >= a.t), q AS (SELECT p.*, a.t AS t1, a.cum AS c1 FROM p ASOF LEFT JOIN a ON p.series = a.series AND p.hi >= a.t)
        SELECT series, id AS region, CAST(trunc(lo) AS BIGINT) AS lo, CAST(trunc(hi) AS BIGINT) AS hi, CASE WHEN t0 < t1 THEN c1 - c0 - (SELECT count(*) FROM events_ e WHERE e.kind = 'error' AND e.series = q.series AND e.t > q.lo AND e.t <= q.hi) END AS events, coalesce(t0 < t1, false) AS pinned FROM q""",
    "g4_slack_screen": f"""WITH {EVENTS}, s AS (SELECT series, t, v % 40 - 35 - (SELECT count(*) FROM events_ c WHERE c.kind = 'click' AND c.series = a.series AND c.t <= a.t) AS k FROM events_ a WHERE kind = 'purchase'),
        z AS (SELECT series, t // {48 * HOUR} AS z, min(k) AS lo, max(k) AS hi FROM s GROUP BY ALL), w AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY z) AS i, count(*) OVER (PARTITION BY series) AS n FROM z), h AS (SELECT *, greatest(1, n // 5) AS head FROM w),
        g AS (SELECT series, least(min(lo), 0) AS low, max(hi) AS high, count(*) AS zones, coalesce(min(lo) FILTER (i > head), 0) AS tail, coalesce(min(lo) FILTER (i > head AND i <= head + greatest(1, (n - head) // 2)), 0) AS half FROM h GROUP BY series)
        SELECT series, low, high, zones, tail, CASE WHEN low >= -15 THEN 'fine' WHEN tail >= -35 THEN 'recovers' WHEN tail > half THEN 'suspect' ELSE 'deepens' END AS verdict FROM g""",
    "g5_run_drift": f"""WITH {EVENTS}, {SPANS('h', 'view', 4)}, r AS (SELECT series, t // {96 * HOUR} AS run, min(t) AS s, max(t) AS e, arg_min(v, t) AS v0, arg_max(v, t) AS v1, count(*) AS n FROM events_ GROUP BY ALL HAVING count(*) >= 5)
        SELECT series, run, n AS reads, v1 - v0 - (SELECT count(*) FROM events_ c WHERE c.kind = 'click' AND c.series = r.series AND c.t > r.s - {HOUR} AND c.t <= r.e - {HOUR}) AS drift, EXISTS (SELECT 1 FROM h WHERE h.series = r.series AND r.s < h.e AND h.s < r.e) AS held FROM r WHERE v1 - v0 >= 5""",
    "g7_deficit_segments": f"""WITH {EVENTS}, d AS (SELECT series, t, (SELECT count(*) FROM events_ c WHERE c.kind = 'click' AND c.series = a.series AND c.t <= a.t - {HOUR}) - v % 3 AS d FROM events_ a),
        n AS (SELECT *, CASE WHEN d = lag(d) OVER w THEN 0 ELSE 1 END AS new FROM d WINDOW w AS (PARTITION BY series ORDER BY t)), g AS (SELECT *, sum(new) OVER (PARTITION BY series ORDER BY t) AS run FROM n)
        SELECT series, d AS deficit, min(t) AS t0, max(t) AS t1, count(*) AS n FROM g GROUP BY series, run, d HAVING max(t) - min(t) >= {HOUR}""",
    "g9_price_clusters": f"""WITH {EVENTS}, {SPANS('v', 'view', 1)}, r AS (SELECT series, t, max(v) AS error, t // {240 * HOUR} AS run FROM events_ WHERE kind = 'purchase' GROUP BY ALL),
        a AS (SELECT v.series, v.id, s, e, v.id % 50 AS ticks, r.t AS bt, r.error AS be, r.run AS br FROM v ASOF LEFT JOIN r ON v.series = r.series AND v.s >= r.t), b AS (SELECT a.*, r.t AS at, r.error AS ae, r.run AS ar FROM a ASOF LEFT JOIN r ON a.series = r.series AND a.e <= r.t),
        n AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS c FROM (SELECT *, coalesce(lag("at") OVER (PARTITION BY series ORDER BY s, e) <= bt, false) AS new FROM b)),
        g AS (SELECT series, c, min(s) AS s, max(e) AS e, count(*) AS regions, sum(ticks) AS ticks, arg_min(struct_pack(t := bt, e := be, r := br), struct_pack(s, e)) AS f, arg_max(struct_pack(t := "at", e := ae, r := ar), struct_pack(s, e)) AS l FROM n GROUP BY ALL),
        p AS (SELECT *, ticks + l.e - f.e AS p, CASE WHEN f.t IS NULL OR s - f.t > {40 * HOUR} THEN 'no_before' WHEN l.t IS NULL OR l.t - e > {40 * HOUR} THEN 'no_after' WHEN l.r <> f.r THEN 'run_change' WHEN ticks + l.e - f.e < 0 THEN 'falls' END AS refusal FROM g)
        SELECT series, s, e, regions, CASE WHEN refusal IS NULL THEN CAST(p AS BIGINT) END AS price, refusal FROM p""".replace("r.t AS at", 'r.t AS "at"'),
    "g10_price_rails": f"""WITH {EVENTS}, {SPANS('v', 'view', 5)}, r AS (SELECT series, t, max(v) AS v FROM events_ WHERE kind = 'purchase' GROUP BY ALL),
        a AS (SELECT v.series, s, e, r.t AS t0, r.v AS v0 FROM v ASOF LEFT JOIN r ON v.series = r.series AND v.s > r.t), b AS (SELECT a.*, r.t AS t1, r.v AS v1 FROM a ASOF LEFT JOIN r ON a.series = r.series AND a.e < r.t),
        x AS (SELECT *, CASE WHEN t0 IS NULL OR t1 IS NULL THEN 'no_bracket' WHEN EXISTS (SELECT 1 FROM events_ z WHERE z.kind = 'signup' AND z.k < 30 AND z.series = b.series AND z.t > t0 AND z.t <= t1) THEN 'reset' END AS refusal, (SELECT count(*) FROM events_ c WHERE c.kind = 'click' AND c.series = b.series AND c.t > t0 AND c.t <= t1) AS n FROM b)
        SELECT series, s, e, CASE WHEN refusal IS NULL THEN v1 - v0 - n END AS price, refusal FROM x""",
    "g11_allocate": f"WITH {_ALLOC}, x AS (SELECT *, total * weight // sum(weight) OVER w AS d, total * weight % sum(weight) OVER w AS m, sum(weight) OVER w AS ws FROM r WINDOW w AS (PARTITION BY l_orderkey)) SELECT l_orderkey, item, CAST(d + CASE WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY m DESC, item) <= total - sum(d) OVER (PARTITION BY l_orderkey) THEN 1 ELSE 0 END AS BIGINT) AS share FROM x",
    "g11_allocate_pinned": f"WITH {_ALLOC}, y AS (SELECT *, p % 5 = 0 AS pin FROM r), z AS (SELECT *, greatest(0, total - 1000 * count(*) FILTER (pin) OVER w) AS rest, sum(weight) FILTER (NOT pin) OVER w AS ws FROM y WINDOW w AS (PARTITION BY l_orderkey)), x AS (SELECT *, CASE WHEN NOT pin THEN rest * weight // ws END AS d FROM z) SELECT l_orderkey, item, CAST(CASE WHEN pin THEN 1000 ELSE d + CASE WHEN row_number() OVER (PARTITION BY l_orderkey, pin ORDER BY weight DESC, item) = 1 THEN rest - sum(d) OVER (PARTITION BY l_orderkey) ELSE 0 END END AS BIGINT) AS share FROM x",
    "g14_search_rates": f"WITH {EVENTS}, r AS (SELECT id AS key, v * 3 AS head, v * 3 + k * 12 + 1 AS tail, k % 7 + 1 AS rate, k * 2 + v % 9 AS target FROM events_ WHERE kind = 'view'), c AS (SELECT key, g.range AS c, rate FROM r, range(1, 33) g WHERE tail * g.range // 12 - head * g.range // 12 = target QUALIFY row_number() OVER (PARTITION BY key ORDER BY abs(g.range - rate), g.range) = 1) SELECT r.key, c AS new_rate FROM r LEFT JOIN c ON r.key = c.key",
    "g16_verdict_ladder": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'SHIP' WHEN o_totalprice < 50000 THEN 'PARK' WHEN o_orderpriority LIKE '1%' THEN 'SHIP' ELSE 'PARK' END AS verdict, CASE WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_totalprice < 50000 THEN 'small' WHEN o_orderpriority LIKE '1%' THEN 'urgent' WHEN o_totalprice > 400000 THEN 'large' ELSE 'no_rule' END AS reason FROM orders",
    "g17_closer": "WITH r AS (SELECT l_orderkey, count(*) AS o, CASE WHEN l_orderkey % 8 <> 0 THEN l_orderkey % 6 END AS t, CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey % 7 END AS f FROM lineitem GROUP BY l_orderkey), v AS (SELECT l_orderkey, abs(o - f) - abs(t - f) AS gain, CASE WHEN t IS NULL THEN 'not_converted' WHEN f IS NULL AND o = t THEN 'same_no_reference' WHEN f IS NULL THEN 'differs_no_reference' WHEN o = f AND t = f THEN 'both_exact' WHEN t = f THEN 'theirs_exact' WHEN o = f THEN 'ours_exact' WHEN abs(t - f) < abs(o - f) THEN 'theirs_closer' WHEN abs(o - f) < abs(t - f) THEN 'ours_closer' ELSE 'same_distance' END AS verdict FROM r) SELECT l_orderkey, verdict, gain, list_position(['theirs_exact', 'theirs_closer', 'both_exact', 'same_distance', 'same_no_reference', 'differs_no_reference', 'ours_closer', 'ours_exact', 'not_converted'], verdict) AS rank FROM v",
    "g18_worklist": "WITH c AS (SELECT o_custkey, o_orderkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2), m AS (SELECT o_custkey, o_orderkey, abs(n - o_orderkey % 7) AS miss FROM c WHERE abs(n - o_orderkey % 7) > 1), k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY miss, o_orderkey) AS r FROM m) SELECT o_custkey, count(*) AS n, string_agg(o_orderkey, ',' ORDER BY r) FILTER (r <= 5) AS names FROM k GROUP BY 1",
    "g19_derive_manifest": "SELECT o_orderkey AS chart, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 5 < 2 THEN 'repaired' WHEN o_orderkey % 3 = 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 6 <> 0 THEN 'upstream_exact' WHEN o_orderkey % 13 = 0 OR o_orderkey % 5 >= 2 THEN 'still_wrong' ELSE 'other' END AS state FROM orders",
}
