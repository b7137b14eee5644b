"""Queries C1 to C15 over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as op
from ..operators._range import asof, nearest
from .adapters import EVENTS, HOUR, MINUTE, SPANS, events, spans

BY = ["series"]
DAY = 24 * HOUR


def pair_holds(spark, sf):
    """Views open a hold and purchases close it, in columns of k % 3."""
    rows = events(spark, sf).filter("kind IN ('view', 'purchase')")
    notes = rows.select("series", (F.col("k") % 3).alias("col"), "t", F.when(F.col("kind") == "view", "2").otherwise("3").alias("sym"))
    return op.pair_holds(notes)


def union_intervals(spark, sf):
    return op.union_intervals(spans(spark, sf), BY, eps=0)


def cluster_by_gap(spark, sf):
    rows = op.cluster_by_gap(events(spark, sf), BY, "t", 6 * HOUR)
    return rows.groupBy("series", "cluster").agg(F.count("*").alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"))


def cluster_by_end(spark, sf):
    rows = op.cluster_by_gap(spans(spark, sf), BY, "s", HOUR, end="e")
    return rows.groupBy("series", "cluster").agg(F.count("*").alias("n"), F.min("s").alias("t0"), F.max("e").alias("t1"))


def cluster_price(spark, sf):
    rows = events(spark, sf, "view").filter("k > 0").select("series", F.col("t").alias("s"), (F.col("t") + F.col("k") * 20 * MINUTE).alias("e"), F.expr("CASE WHEN v % 3 = 0 THEN v END").alias("price"), F.concat(F.lit("c"), F.col("v") % 4).alias("cause"))
    return op.cluster_price(rows, BY, eps=0)


def _hours(spark, sf):
    ends = events(spark, sf).groupBy("series").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    return ends.select("series", F.explode(F.sequence(F.floor(F.col("a") / DAY) * DAY, F.ceil(F.col("b") / DAY) * DAY, F.lit(DAY))).alias("t"))


def interpolate(spark, sf):
    points = events(spark, sf).groupBy("series", "t").agg(F.max("v").alias("y"))
    return op.interpolate(points, _hours(spark, sf), BY).select("series", "t", F.round("y", 6).alias("y"))


def interpolate_extend(spark, sf):
    points = events(spark, sf).groupBy("series", "t").agg(F.max("v").alias("y"))
    return op.interpolate(points, _hours(spark, sf), BY, outside="extend", bucket=7 * DAY).select("series", "t", F.round(F.col("y") / 1000, 4).alias("y"))


def tile(spark, sf):
    rows = op.tile(spans(spark, sf), 3 * HOUR, remain=15 * MINUTE, sliver=12 * MINUTE)
    return rows.select("series", "id", "tile", F.col("t0").cast("long").alias("t0"), F.col("t1").cast("long").alias("t1"))


def _regions(spark, sf):
    return op.union_intervals(spans(spark, sf, "click", 5), BY, eps=0).select("series", "region", F.col("s").alias("rs"), F.col("e").alias("re"))


def assign_by_overlap(spark, sf):
    segments = spans(spark, sf).withColumnRenamed("id", "segment")
    return op.assign_by_overlap(segments, _regions(spark, sf), BY, 12 * HOUR).select("series", "segment", "region", F.col("overlap").cast("long").alias("overlap"))


def split_by_overlap(spark, sf):
    windows = spans(spark, sf).select("series", F.col("id").alias("window"), "s", "e", F.lit(100).alias("value"))
    return op.split_by_overlap(windows, _regions(spark, sf), BY, 12 * HOUR).select("series", "window", "region", F.round("share", 6).alias("share"))


def _points(spark, sf, kind="click"):
    return events(spark, sf, kind).select("series", "id", F.col("t").alias("s"), F.col("t").alias("e"))


def overlap_filter(spark, sf):
    """Clicks with no view span within ten minutes."""
    near = spans(spark, sf).select("series", F.col("s").alias("ps"), F.col("e").alias("pe"))
    return op.overlap_filter(_points(spark, sf), near, BY, 12 * HOUR, pad=10 * MINUTE)


def overlap_count(spark, sf):
    near = spans(spark, sf).select("series", F.col("s").alias("ps"), F.col("e").alias("pe"))
    return op.overlap_filter(_points(spark, sf), near, BY, 12 * HOUR, pad=10 * MINUTE, keep="count").select("series", "id", "n_spans")


def count_between(spark, sf):
    """Clicks inside each view span, (start, end]."""
    queries = spans(spark, sf).select("series", "id", F.col("s").alias("lo"), F.col("e").alias("hi"))
    return op.count_between(events(spark, sf, "click").select("series", "t"), queries, BY, bucket=10 * DAY)


def _schedule(spark, sf):
    rows = events(spark, sf, "signup")
    return rows.select("series", F.floor(F.col("t") / HOUR - 473_400).alias("beat"), (F.col("k") % 5).alias("value"), F.col("id").alias("pos"))


def rate_spans(spark, sf):
    return op.rate_spans(_schedule(spark, sf), BY)


def spans_where(spark, sf):
    return op.spans_where(op.rate_spans(_schedule(spark, sf), BY), BY, F.col("value") >= 2)


def patch_steps(spark, sf):
    """The schedule with the hours 200 to 260 set to rate 9."""
    steps = op.rate_spans(_schedule(spark, sf), BY).select("series", F.col("b0").alias("beat"), "value")
    patch = steps.select("series").distinct().select("series", F.lit(200).cast("long").alias("b0"), F.lit(260).cast("long").alias("b1"), F.lit(9).cast("long").alias("rate"))
    return op.patch_steps(steps, patch, BY)


def lattice_count(spark, sf):
    """Holds from view spans, tap rows from clicks and exclusions from error spans, in hours as beats (unit 12)."""
    beat = lambda c: (F.floor(F.col(c) / (5 * MINUTE)) - 473_400 * 12).alias(c)
    holds = spans(spark, sf).select("series", beat("s").alias("head"), beat("e").alias("tail"))
    steps = op.rate_spans(_schedule(spark, sf).withColumn("beat", F.col("beat") * 12), BY)
    excluded = spans(spark, sf, "error", 3).select("series", beat("s"), beat("e"))
    rows = events(spark, sf, "click").select("series", beat("t").alias("beat"))
    return op.lattice_count(holds, steps, excluded, rows, BY, 12, 144).drop("region")


def rule_census(spark, sf):
    """Counting rules for a customer's clicks against the number of views plus 3 (by user)."""
    rows = events(spark, sf)
    truth = rows.groupBy("series").agg(F.count_if(F.col("kind") == "view").alias("expected"))
    counted = lambda what: lambda df: df.groupBy("series").agg(F.count_if(what).alias("n"))
    rules = {"clicks": counted(F.col("kind") == "click"), "large_clicks": counted((F.col("kind") == "click") & (F.col("k") >= 10)), "errors": counted(F.col("kind") == "error")}
    return op.rule_census(rows, truth, rules, "clicks", BY)


def asof_previous(spark, sf):
    """the last purchase at or before each click."""
    right = events(spark, sf, "purchase").select("series", "t", F.col("t").alias("moment"), F.col("v").alias("pv"))
    return asof(events(spark, sf, "click").select("series", "id", "t"), right, BY, "t", ["moment", "pv"], bucket=5 * DAY).select("series", "id", "moment", "pv")


def nearest_within(spark, sf):
    """the purchase nearest to each click, within a day."""
    return nearest(events(spark, sf, "click").select("series", "id", "t"), events(spark, sf, "purchase").select("series", "t"), BY, "t", "moment", DAY).select("series", "id", "moment")


_V = f"WITH {EVENTS}, {SPANS('views', 'view', 20)}"
_R = f"{SPANS('c', 'click', 5)}, cm AS (SELECT *, max(e) OVER (PARTITION BY series ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM c), cn AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY s, e ROWS UNBOUNDED PRECEDING) - 1 AS region FROM cm), regions AS (SELECT series, CAST(region AS BIGINT) AS region, min(s) AS rs, max(e) AS re FROM cn GROUP BY ALL)"
_PTS = f"ends AS (SELECT series, min(t) AS a, max(t) AS b FROM events_ GROUP BY series), q AS (SELECT series, unnest(range(CAST(floor(a / {DAY}) * {DAY} AS BIGINT), CAST(ceil(b / {DAY}) * {DAY} AS BIGINT) + 1, {DAY})) AS t FROM ends), pts AS (SELECT series, t, max(v) AS y FROM events_ GROUP BY ALL), lines AS (SELECT *, lead(t) OVER w AS nt, lead(y) OVER w AS ny, lag(t) OVER w AS pt, lag(y) OVER w AS py FROM pts WINDOW w AS (PARTITION BY series ORDER BY t)), f AS (SELECT series, arg_min(struct_pack(t := t, y := y, nt := nt, ny := ny), t) AS h FROM lines GROUP BY series), j AS (SELECT q.series, q.t AS qt, l.*, f.h FROM q ASOF LEFT JOIN lines l ON q.series = l.series AND q.t >= l.t JOIN f ON q.series = f.series)"
_SCHED = "sched AS (SELECT series, CAST(floor(t / 3600000000 - 473400) AS BIGINT) AS beat, arg_max(k % 5, id) AS value FROM events_ WHERE kind = 'signup' AND t >= 473400 * 3600000000 GROUP BY 1, 2), first AS (SELECT series, min(beat) AS f FROM sched GROUP BY 1), every AS (SELECT series, beat, value FROM sched UNION ALL SELECT series, 0, 1 FROM first WHERE f > 0), steps AS (SELECT series, beat AS b0, lead(beat) OVER (PARTITION BY series ORDER BY beat) AS b1, value FROM every)"

QUERIES = {
    "c1_pair_holds": pair_holds, "c2_union_intervals": union_intervals, "c3_cluster_by_gap": cluster_by_gap, "c3_cluster_by_end": cluster_by_end, "c4_cluster_price": cluster_price,
    "c5_interpolate": interpolate, "c5_interpolate_extend": interpolate_extend, "c6_tile": tile, "c7_assign_by_overlap": assign_by_overlap, "c8_split_by_overlap": split_by_overlap,
    "c9_overlap_filter": overlap_filter, "c9_overlap_count": overlap_count, "c10_count_between": count_between, "c11_rate_spans": rate_spans, "c12_spans_where": spans_where,
    "c13_patch_steps": patch_steps, "c14_lattice_count": lattice_count, "c15_rule_census": rule_census, "f2_asof_previous": asof_previous, "f2_nearest_within": nearest_within,
}

SQL = {
    "c1_pair_holds": f"WITH {EVENTS}, n AS (SELECT series, k % 3 AS col, t, CASE kind WHEN 'view' THEN '2' ELSE '3' END AS sym FROM events_ WHERE kind IN ('view', 'purchase')), h AS (SELECT series, col, max(CASE WHEN sym = '2' THEN t END) OVER (PARTITION BY series, col ORDER BY t, sym ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS head, max(CASE WHEN sym = '3' THEN t END) OVER (PARTITION BY series, col ORDER BY t, sym ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, t AS tail, sym FROM n) SELECT series, col, head, tail FROM h WHERE sym = '3' AND head IS NOT NULL AND (before IS NULL OR before < head)",
    "c2_union_intervals": _V + """, lvl AS (SELECT series, p, sum(d) AS d FROM (SELECT series, s AS p, 1 AS d FROM views UNION ALL SELECT series, e, -1 FROM views) GROUP BY ALL),
        run AS (SELECT series, p, d, sum(d) OVER (PARTITION BY series ORDER BY p ROWS UNBOUNDED PRECEDING) AS n FROM lvl),
        st AS (SELECT series, p AS s, row_number() OVER (PARTITION BY series ORDER BY p) - 1 AS region FROM (SELECT *, coalesce(lag(n) OVER (PARTITION BY series ORDER BY p), 0) AS b FROM run) WHERE b = 0 AND n > 0),
        en AS (SELECT series, p AS e, row_number() OVER (PARTITION BY series ORDER BY p) - 1 AS region FROM run WHERE n = 0 AND d < 0)
        SELECT st.series, st.region, s, e, (SELECT count(*) FROM views v WHERE v.series = st.series AND v.s >= st.s AND v.e <= en.e) AS n FROM st JOIN en ON st.series = en.series AND st.region = en.region""",
    "c3_cluster_by_gap": f"WITH {EVENTS}, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY series ORDER BY t) <= {6 * HOUR} THEN 0 ELSE 1 END AS new FROM events_), c AS (SELECT *, sum(new) OVER (PARTITION BY series ORDER BY t) - 1 AS cluster FROM g) SELECT series, cluster, count(*) AS n, min(t) AS t0, max(t) AS t1 FROM c GROUP BY ALL",
    "c3_cluster_by_end": _V + f", m AS (SELECT *, max(e) OVER (PARTITION BY series ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM views), c AS (SELECT *, sum(CASE WHEN s <= pe + {HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY s, e ROWS UNBOUNDED PRECEDING) - 1 AS cluster FROM m) SELECT series, cluster, count(*) AS n, min(s) AS t0, max(e) AS t1 FROM c GROUP BY ALL",
    "c4_cluster_price": f"""WITH {EVENTS}, r AS (SELECT series, t AS s, t + k * {20 * MINUTE} AS e, CASE WHEN v % 3 = 0 THEN v END AS price, 'c' || (v % 4) AS cause FROM events_ WHERE kind = 'view' AND k > 0),
        m AS (SELECT *, max(e) OVER (PARTITION BY series ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM r),
        c AS (SELECT *, sum(CASE WHEN s <= pe THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY s, e ROWS UNBOUNDED PRECEDING) - 1 AS region FROM m),
        k0 AS (SELECT series, region, cause, count(*) AS m FROM c WHERE price IS NULL GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY series, region ORDER BY m DESC, cause) AS o FROM k0),
        a AS (SELECT series, region, min(s) AS s, max(e) AS e, count(*) AS n, max(price) AS price FROM c GROUP BY ALL)
        SELECT a.*, CASE WHEN price IS NULL THEN k.cause END AS cause FROM a LEFT JOIN k ON a.series = k.series AND a.region = k.region AND o = 1""",
    "c5_interpolate": f"WITH {EVENTS}, {_PTS} SELECT series, qt AS t, round(CASE WHEN t IS NULL THEN h.y WHEN nt IS NULL THEN y ELSE y + (ny - y) / (nt - t) * (qt - t) END, 6) AS y FROM j",
    "c5_interpolate_extend": f"WITH {EVENTS}, {_PTS} SELECT series, qt AS t, round((CASE WHEN t IS NULL THEN h.y + (h.ny - h.y) / (h.nt - h.t) * (qt - h.t) WHEN nt IS NULL THEN y + (y - py) / (t - pt) * (qt - t) ELSE y + (ny - y) / (nt - t) * (qt - t) END) / 1000, 4) AS y FROM j",
    "c6_tile": _V + f", n AS (SELECT *, greatest(0, CAST(ceil((e - s - {15 * MINUTE}) / {3 * HOUR}) AS BIGINT)) AS n FROM views), x AS (SELECT series, id, s, e, unnest(range(n)) AS tile FROM n) SELECT series, id, tile, s + tile * {3 * HOUR} AS t0, least(s + (tile + 1) * {3 * HOUR}, e) AS t1 FROM x WHERE least(s + (tile + 1) * {3 * HOUR}, e) - (s + tile * {3 * HOUR}) >= {12 * MINUTE}",
    "c7_assign_by_overlap": _V + f""", {_R}, p AS (SELECT v.series, v.id, region, least(e, re) - greatest(s, rs) AS o FROM views v JOIN regions r ON v.series = r.series AND s < re AND rs < e),
        b AS (SELECT series, id, region, o FROM p QUALIFY row_number() OVER (PARTITION BY series, id ORDER BY o DESC, region) = 1),
        n AS (SELECT v.series, v.id, x.region FROM views v JOIN (SELECT series, rs AS m, region FROM regions UNION ALL SELECT series, re, region FROM regions) x ON v.series = x.series
              QUALIFY row_number() OVER (PARTITION BY v.series, v.id ORDER BY abs(m - (s + e) / 2), m, x.region) = 1)
        SELECT v.series, v.id AS segment, coalesce(b.region, n.region) AS region, coalesce(o, 0) AS overlap FROM views v LEFT JOIN b ON v.series = b.series AND v.id = b.id LEFT JOIN n ON v.series = n.series AND v.id = n.id""",
    "c8_split_by_overlap": _V + f", {_R}, p AS (SELECT v.series, v.id, region, least(e, re) - greatest(s, rs) AS o FROM views v JOIN regions r ON v.series = r.series AND s < re AND rs < e) SELECT v.series, v.id AS window, region, round(100 * o / sum(o) OVER (PARTITION BY v.series, v.id), 6) AS share FROM views v LEFT JOIN p ON v.series = p.series AND v.id = p.id",
    "c9_overlap_filter": _V + f" SELECT series, id, t AS s, t AS e FROM events_ c WHERE kind = 'click' AND NOT EXISTS (SELECT 1 FROM views v WHERE v.series = c.series AND c.t - {10 * MINUTE} < v.e AND v.s < c.t + {10 * MINUTE})",
    "c9_overlap_count": _V + f" SELECT series, id, (SELECT count(*) FROM views v WHERE v.series = c.series AND c.t - {10 * MINUTE} < v.e AND v.s < c.t + {10 * MINUTE}) AS n_spans FROM events_ c WHERE kind = 'click'",
    "c10_count_between": _V + " SELECT series, id, s AS lo, e AS hi, (SELECT count(*) FROM events_ c WHERE c.kind = 'click' AND c.series = v.series AND c.t > v.s AND c.t <= v.e) AS n FROM views v",
    "c11_rate_spans": f"WITH {EVENTS}, {_SCHED} SELECT series, b0, b1, value FROM steps",
    "c12_spans_where": f"WITH {EVENTS}, {_SCHED}, g AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY b0) - row_number() OVER (PARTITION BY series, value >= 2 ORDER BY b0) AS island FROM steps) SELECT series, min(b0) AS b0, arg_max(coalesce(b1, -1), b0) AS b1 FROM g WHERE value >= 2 GROUP BY series, island".replace("arg_max(coalesce(b1, -1), b0)", "nullif(arg_max(coalesce(b1, -1), b0), -1)"),
    "c13_patch_steps": f"WITH {EVENTS}, {_SCHED} SELECT series, b0 AS beat, value FROM steps WHERE b0 < 200 OR b0 > 260 UNION ALL SELECT DISTINCT series, 200, 9 FROM steps UNION ALL SELECT series, 260, arg_max(value, b0) FROM steps WHERE b0 <= 260 GROUP BY series",
    "c14_lattice_count": f"""WITH {EVENTS}, {SPANS('views', 'view', 20)}, {SPANS('errs', 'error', 3)}, {_SCHED},
        h AS (SELECT series, CAST(floor(s / {5 * MINUTE}) - 5680800 AS BIGINT) AS head, CAST(floor(e / {5 * MINUTE}) - 5680800 AS BIGINT) AS tail FROM views),
        x AS (SELECT series, CAST(floor(s / {5 * MINUTE}) - 5680800 AS BIGINT) AS s, CAST(floor(e / {5 * MINUTE}) - 5680800 AS BIGINT) AS e FROM errs),
        taps AS (SELECT DISTINCT series, CAST(floor(t / {5 * MINUTE}) - 5680800 AS BIGINT) AS beat FROM events_ WHERE kind = 'click'),
        m AS (SELECT *, max(tail) OVER (PARTITION BY series ORDER BY head, tail ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM h),
        n AS (SELECT *, sum(CASE WHEN head <= pe THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY head, tail ROWS UNBOUNDED PRECEDING) AS region FROM m),
        r AS (SELECT series, region, min(head) AS b0, max(tail) AS b1 FROM n GROUP BY ALL),
        heads AS (SELECT DISTINCT series, head AS beat FROM h),
        lone AS (SELECT * FROM heads a WHERE NOT EXISTS (SELECT 1 FROM taps t WHERE t.series = a.series AND t.beat = a.beat) AND NOT EXISTS (SELECT 1 FROM x WHERE x.series = a.series AND a.beat >= x.s AND a.beat < x.e)),
        hn AS (SELECT r.series, r.region, count(*) AS heads FROM r JOIN lone l ON l.series = r.series AND l.beat BETWEEN b0 AND b1 GROUP BY ALL),
        fine AS (SELECT r.series, r.region, s.value, unnest(range(CAST(floor(r.b0 * s.value / 12) AS BIGINT), CAST(ceil(r.b1 * s.value / 12) AS BIGINT) + 1)) AS k, r.b0, r.b1, s.b0 * 12 AS f, coalesce(s.b1 * 12, 99999999) AS too FROM r JOIN steps s ON r.series = s.series AND s.value > 0),
        lat AS (SELECT series, region, value, k * 12 / value AS p FROM fine WHERE k * 12 > b0 * value AND k * 12 <= b1 * value AND k * 12 >= f * value AND k * 12 < too * value),
        good AS (SELECT * FROM lat l WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.series = l.series AND l.p >= x.s AND l.p < x.e) AND NOT EXISTS (SELECT 1 FROM taps t WHERE t.series = l.series AND t.beat = l.p) AND NOT EXISTS (SELECT 1 FROM heads t WHERE t.series = l.series AND t.beat = l.p)),
        tn AS (SELECT series, region, count(*) AS ticks FROM good GROUP BY ALL)
        SELECT r.series, r.b0, r.b1, coalesce(heads, 0) AS heads, coalesce(ticks, 0) AS ticks, coalesce(heads, 0) + coalesce(ticks, 0) AS events
        FROM r LEFT JOIN hn ON r.series = hn.series AND r.region = hn.region LEFT JOIN tn ON r.series = tn.series AND r.region = tn.region""",
    "c15_rule_census": f"WITH {EVENTS}, u AS (SELECT series, count(*) FILTER (kind = 'view') AS e, count(*) FILTER (kind = 'click') AS clicks, count(*) FILTER (kind = 'click' AND k >= 10) AS large_clicks, count(*) FILTER (kind = 'error') AS errors FROM events_ GROUP BY 1), l AS (SELECT series, e, clicks = e AS base, unnest(['clicks', 'large_clicks', 'errors']) AS rule, unnest([clicks, large_clicks, errors]) AS n FROM u) SELECT rule, count(*) AS n, count(*) FILTER (n = e) AS exact, count(*) FILTER (base AND n <> e) AS breaks, count(*) FILTER (NOT base AND n = e) AS fixes, count(*) FILTER (abs(n - e) <= 5) AS within_5 FROM l GROUP BY rule",
    "f2_asof_previous": f"WITH {EVENTS}, p AS (SELECT series, t, max(v) AS v FROM events_ WHERE kind = 'purchase' GROUP BY ALL) SELECT c.series, c.id, p.t AS moment, p.v AS pv FROM (SELECT * FROM events_ WHERE kind = 'click') c ASOF LEFT JOIN p ON c.series = p.series AND c.t >= p.t",
    "f2_nearest_within": f"WITH {EVENTS}, n AS (SELECT c.series, c.id, p.t AS moment, abs(p.t - c.t) AS d FROM events_ c JOIN events_ p ON c.series = p.series AND p.kind = 'purchase' WHERE c.kind = 'click' QUALIFY row_number() OVER (PARTITION BY c.id ORDER BY abs(p.t - c.t), p.t) = 1) SELECT c.series, c.id, CASE WHEN d <= {DAY} THEN moment END AS moment FROM events_ c LEFT JOIN n ON c.id = n.id WHERE c.kind = 'click'",
}
