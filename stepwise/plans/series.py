"""Queries D1 to D14 over the events of each user."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as op
from .adapters import EVENTS, HOUR, MINUTE, SPANS, events, spans

BY = ["series"]
C = F.col


def _reads(spark, sf):
    """Reads with values of 0 to 9, so that they recur; one for each instant."""
    return events(spark, sf).select("series", "id", "t", (F.col("v") % 10).alias("v"), "conf")


def persistent(spark, sf):
    return op.persistent(_reads(spark, sf), BY).select("series", "id", "v")


def plateaus(spark, sf):
    return op.plateaus(_reads(spark, sf).withColumn("v", F.col("v") % 3), BY, 2, 24 * HOUR, 0.1)


def still_points(spark, sf):
    rows = op.still_points(_reads(spark, sf).withColumn("v", F.col("v") % 3), BY, HOUR)
    return rows.select("series", F.floor("t").cast("long").alias("t"), "v")


def lnds(spark, sf):
    return op.lnds(events(spark, sf), BY).groupBy("series").agg(F.count("*").alias("n"))


def monotone_stack(spark, sf):
    return op.monotone_stack(events(spark, sf), BY).select("series", "id", "t", "v")


def continuity_repair(spark, sf):
    return op.continuity_repair(events(spark, sf), BY, 20 / HOUR, 490)


def segment_runs(spark, sf):
    return op.segment_runs(events(spark, sf), BY, 100, 2)


def cut_runs(spark, sf):
    return op.cut_runs(events(spark, sf), BY, 100, 2).select("series", "id", "run")


def confirmed_runs(spark, sf):
    """Reads of hundreds, a run at the least after six days."""
    return op.confirmed_runs(events(spark, sf).withColumn("v", F.floor(C("v") / 20)), BY, 144 * HOUR, 6, 9, 3, 48 * HOUR)


def reset_candidates(spark, sf):
    return op.reset_candidates(events(spark, sf), BY, 150, 30, 100)


def solve_runs(spark, sf):
    """Daily peaks of a user's first ten days, cut by at most three resets, against a total that two runs give."""
    rows = events(spark, sf).withColumn("day", F.floor(F.col("t") / (24 * HOUR)) - 19723).filter("day < 8").groupBy("series", "day").agg(F.max("v").alias("peak"))
    lists = rows.groupBy("series").agg(F.array_sort(F.collect_list(F.struct("day", "peak"))).alias("d")).filter(F.size("d") > 1)
    peaks = F.transform("d", lambda x: x["peak"])
    arrays = lists.select("series", peaks.alias("peaks"), F.slice(peaks, 1, F.size("d") - 1).alias("depths"), F.lit(3).alias("resets"), (F.array_max(peaks) + F.element_at(peaks, 1)).alias("total"), F.lit(400).alias("cap"))
    return op.solve_runs(arrays, BY).select("series", F.array_join(F.transform("chosen", lambda x: x.cast("string")), ",").alias("chosen"), "error")


def best_chain(spark, sf):
    """Purchases as plateaus of as many minutes as their k says."""
    points = events(spark, sf, "purchase").select("series", C("t").alias("t0"), (C("t") + C("k") * MINUTE).alias("t1"), (C("v") % 60).alias("v"))
    return op.best_chain(points, BY, 5 / HOUR)


def _runs(spark, sf):
    return events(spark, sf).withColumn("run", F.floor(F.col("t") / (96 * HOUR)))


def cumulate(spark, sf):
    runs = _runs(spark, sf)
    totals = runs.groupBy("series").agg((F.count("*") * 40).alias("total"))
    return op.cumulate(runs, totals, BY)


def _windows(spark, sf):
    """Each view opens a window up to 40 hours, or to the user's next view."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("series").orderBy("s")
    rows = events(spark, sf, "view").select("series", F.col("t").alias("s"), (F.col("v") % 10).alias("expected"), F.col("id").alias("window"))
    return rows.withColumn("e", F.least(F.col("s") + 40 * HOUR, F.coalesce(F.lead("s").over(order) - 1, F.col("s") + 40 * HOUR)))


def window_mode(spark, sf):
    reads = _reads(spark, sf).withColumn("v", F.col("v") % 3).withColumn("run", F.floor(F.col("t") / (240 * HOUR)))
    return op.window_mode(reads, _windows(spark, sf).withColumn("expected", F.col("expected") % 3), BY, frames=2, events=events(spark, sf, "error"), jitter=2 * HOUR)


def window_median_pull(spark, sf):
    day = F.floor(F.col("t") / (96 * HOUR))
    rows = events(spark, sf).select("series", day.alias("cell"), (day * 96 * HOUR + 48 * HOUR).alias("at"), "t", "v")
    return op.window_median_pull(rows, BY, 700)


def measure_lag(spark, sf):
    taps = events(spark, sf, "click").select("series", "t")
    reads = events(spark, sf).withColumn("run", F.floor(C("t") / (240 * HOUR)))
    out = op.measure_lag(reads, taps, BY, spans(spark, sf, "error", 6), 24 * HOUR, 3 * HOUR, HOUR, 30 * HOUR, -1.0, 4)
    return out.select("series", F.floor("lag").cast("long").alias("lag"), "n")


def resample(spark, sf):
    return op.resample(_reads(spark, sf), BY, 12 * HOUR)


QUERIES = {
    "d1_persistent": persistent, "d2_plateaus": plateaus, "d2_still_points": still_points, "d3_lnds": lnds, "d4_monotone_stack": monotone_stack, "d5_continuity_repair": continuity_repair, "d6_cut_runs": cut_runs, "d6_confirmed_runs": confirmed_runs, "d6_segment_runs": segment_runs,
    "d7_reset_candidates": reset_candidates, "d8_solve_runs": solve_runs, "d9_best_chain": best_chain, "d10_cumulate": cumulate, "d11_window_mode": window_mode, "d12_window_median_pull": window_median_pull, "d13_measure_lag": measure_lag, "d14_resample": resample,
}

_R = f"WITH {EVENTS}, reads AS (SELECT series, id, t, v % 10 AS v, conf FROM events_)"

SQL = {
    "d1_persistent": _R + ", x AS (SELECT *, lead(v) OVER w AS a, lead(v, 2) OVER w AS b FROM reads WINDOW w AS (PARTITION BY series ORDER BY t)) SELECT series, id, v FROM x WHERE v = a OR v = b",
    "d2_plateaus": _R + f", x AS (SELECT series, t, v % 3 AS v, conf, CASE WHEN v % 3 = lag(v % 3) OVER w AND t - lag(t) OVER w < {24 * HOUR} THEN 0 ELSE 1 END AS new FROM reads WINDOW w AS (PARTITION BY series ORDER BY t)), y AS (SELECT *, sum(new) OVER (PARTITION BY series ORDER BY t) AS run FROM x) SELECT series, min(t) AS t0, max(t) AS t1, v, count(*) AS n FROM y GROUP BY series, run, v HAVING count(*) >= 2 AND min(conf) >= 0.1",
    "d2_still_points": _R + f", x AS (SELECT series, t, v % 3 AS v, CASE WHEN v % 3 = lag(v % 3) OVER w THEN 0 ELSE 1 END AS new FROM reads WINDOW w AS (PARTITION BY series ORDER BY t)), y AS (SELECT *, sum(new) OVER (PARTITION BY series ORDER BY t) AS run FROM x) SELECT series, CAST(floor((min(t) + max(t)) / 2) AS BIGINT) AS t, v FROM y GROUP BY series, run, v HAVING max(t) - min(t) >= {HOUR}",
    "d4_monotone_stack": f"WITH {EVENTS} SELECT series, id, t, v FROM events_ a WHERE NOT EXISTS (SELECT 1 FROM events_ b WHERE b.series = a.series AND b.t > a.t AND b.v < a.v)",
    "d8_solve_runs": f"""WITH {EVENTS}, p AS (SELECT series, t // {24 * HOUR} - 19723 AS day, max(v) AS peak FROM events_ WHERE t // {24 * HOUR} - 19723 < 8 GROUP BY ALL),
        l AS (SELECT series, list(peak ORDER BY day) AS p FROM p GROUP BY series HAVING count(*) > 1),
        m AS (SELECT series, p, unnest(range(1 << (len(p) - 1))) AS mask FROM l),
        c AS (SELECT series, p, mask, list_filter(range(len(p) - 1), lambda i: (mask >> i) & 1 = 1) AS c FROM m),
        r AS (SELECT *, list_transform(list_zip(list_concat([0], list_transform(c, lambda i: i + 1)), list_concat(c, [len(p) - 1])), lambda z: list_max(p[z[1] + 1:z[2] + 1])) AS peaks FROM c WHERE len(c) <= 3),
        s AS (SELECT series, c, mask, abs(list_sum(peaks) - list_max(p) - p[1]) AS error, peaks[-1] > 400 AS over, list_max(p) + p[1] AS total FROM r)
        SELECT series, CASE WHEN error <= greatest(3, 0.02 * total) THEN array_to_string(c, ',') END AS chosen, CAST(error AS BIGINT) AS error FROM s
        QUALIFY row_number() OVER (PARTITION BY series ORDER BY error + CASE WHEN over THEN 50 ELSE 0 END, len(c), mask) = 1""",
    "d10_cumulate": f"""WITH {EVENTS}, r AS (SELECT series, t, v, t // {96 * HOUR} AS run FROM events_), tot AS (SELECT series, count(*) * 40 AS total FROM r GROUP BY 1),
        p AS (SELECT series, run, max(v) AS peak FROM r GROUP BY ALL), q AS (SELECT *, max(run) OVER (PARTITION BY series) AS last FROM p),
        z AS (SELECT series, run, last, coalesce(sum(peak) OVER (PARTITION BY series ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, sum(CASE WHEN run < last THEN peak END) OVER (PARTITION BY series) AS early, max(CASE WHEN run = last THEN peak END) OVER (PARTITION BY series) AS final FROM q),
        o AS (SELECT z.series, run, total, CAST(round(b * CASE WHEN early > 0 THEN (total - final) / early ELSE 1 END) AS BIGINT) AS off FROM z JOIN tot ON z.series = tot.series)
        SELECT r.series, r.run, t, off + v AS cum FROM r JOIN o ON r.series = o.series AND r.run = o.run WHERE v <= total AND off + v <= total""",
    "d11_window_mode": _R + f""", w AS (SELECT series, id AS wid, t AS s, v % 3 AS expected, least(t + {40 * HOUR}, coalesce(lead(t) OVER (PARTITION BY series ORDER BY t) - 1, t + {40 * HOUR})) AS e FROM (SELECT series, id, t, v % 10 AS v FROM events_ WHERE kind = 'view')),
        x AS (SELECT w.series, wid, r.v % 3 - expected AS error, count(*) AS n, count(DISTINCT r.t // {240 * HOUR}) AS runs FROM w JOIN reads r ON r.series = w.series AND r.t BETWEEN s AND e AND NOT EXISTS (SELECT 1 FROM events_ z WHERE z.kind = 'error' AND z.series = r.series AND z.t BETWEEN r.t - {2 * HOUR} AND r.t + {2 * HOUR}) GROUP BY ALL),
        y AS (SELECT *, sum(n) OVER (PARTITION BY series, wid) AS frames FROM x QUALIFY row_number() OVER (PARTITION BY series, wid ORDER BY n DESC, error) = 1)
        SELECT series, wid AS window, CASE WHEN n >= 2 AND n >= 0.5 * frames AND runs = 1 THEN error END AS error, n, CAST(frames AS BIGINT) AS frames FROM y""",
    "d6_cut_runs": f"WITH {EVENTS}, n AS (SELECT *, coalesce(max(v) OVER (PARTITION BY series ORDER BY t, v ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) < lag(v) OVER (PARTITION BY series ORDER BY t, v) - 100, false)::INT AS new FROM events_) SELECT series, id, CAST(sum(new) OVER (PARTITION BY series ORDER BY t, v ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM n",
    "d12_window_median_pull": f"""WITH {EVENTS}, a AS (SELECT series, t // {96 * HOUR} AS cell, list(v ORDER BY t, v) AS w, list(abs(t - (t // {96 * HOUR} * {96 * HOUR} + {48 * HOUR})) ORDER BY t, v) AS d FROM events_ GROUP BY ALL),
        b AS (SELECT *, list_sort(w)[len(w) // 2 + 1] AS m FROM a),
        c AS (SELECT *, list_transform(w, lambda v: coalesce(list_sort(list_transform(list_filter(range(10), lambda k: v + 100 * k <= 700), lambda k: [abs(v + 100 * k - m), v + 100 * k]))[1][2], v)) AS p FROM b),
        e AS (SELECT series, cell, w, d, list_sort(p)[len(p) // 2 + 1] AS m FROM c),
        f AS (SELECT *, list_transform(w, lambda v: coalesce(list_sort(list_transform(list_filter(range(10), lambda k: v + 100 * k <= 700), lambda k: [abs(v + 100 * k - m), v + 100 * k]))[1][2], v)) AS p FROM e)
        SELECT series, cell, CAST((CASE WHEN list_max(p) - list_min(p) > 70 THEN w ELSE p END)[list_position(d, list_min(d))] AS BIGINT) AS value FROM f""",
    "d13_measure_lag": f"""WITH {EVENTS}, {SPANS('x', 'error', 6)}, c AS (SELECT series, t, t - lag(t) OVER w AS a, lead(t) OVER w - t AS b FROM events_ WHERE kind = 'click' WINDOW w AS (PARTITION BY series ORDER BY t)),
        l AS (SELECT * FROM c WHERE coalesce(a, 1e18) >= {3 * HOUR} AND coalesce(b, 1e18) >= {3 * HOUR} AND NOT EXISTS (SELECT 1 FROM x WHERE x.series = c.series AND x.s - {3 * HOUR} < c.t AND c.t < x.e + {3 * HOUR})),
        s AS (SELECT series, t FROM (SELECT series, t, v > lag(v) OVER w AND t // {240 * HOUR} = lag(t // {240 * HOUR}) OVER w AS up FROM events_ WINDOW w AS (PARTITION BY series ORDER BY t)) WHERE up),
        d AS (SELECT l.series, s.t - l.t AS d FROM l ASOF JOIN s ON l.series = s.series AND l.t - {HOUR} <= s.t WHERE s.t - l.t <= {30 * HOUR})
        SELECT series, CASE WHEN count(*) >= 4 THEN list_sort(list(d))[count(*) // 2 + 1] ELSE -1 END AS lag, count(*) AS n FROM d GROUP BY series""",
    "d14_resample": _R + f""", e AS (SELECT series, min(t) AS a, max(t) AS b FROM reads GROUP BY 1), g AS (SELECT series, unnest(range(CAST(ceil(a / {12 * HOUR}) AS BIGINT), CAST(floor(b / {12 * HOUR}) AS BIGINT) + 1)) * {12 * HOUR} AS t FROM e),
        j AS (SELECT g.series, g.t, r.v FROM g ASOF JOIN reads r ON g.series = r.series AND g.t >= r.t)
        SELECT series, t, v FROM j QUALIFY lag(v) OVER (PARTITION BY series ORDER BY t) IS DISTINCT FROM v""",
}
