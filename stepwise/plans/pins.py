"""Queries of pinned holds (I10), tiles with pins (C6), heights (J1) and the fine tempo (E7)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import align, intervals
from ..operators import pins as op
from . import intervals as _intervals
from . import signals as _signals
from .adapters import EVENTS, HOUR, MINUTE, SPANS, events, spans

BY = ["series"]
C = F.col


def pin_inputs(spark, sf):
    """View spans as holds, the schedule of the lattice count, clicks as rows, in hours as beats (unit 12); purchases mark the tempo, a second each five minutes and one more for each."""
    beat = lambda c, out: (F.floor(C(c) / (5 * MINUTE)) - 473_400 * 12).alias(out)
    holds = spans(spark, sf, minutes=6).select("series", C("id").alias("hold"), beat("s", "head"), beat("e", "tail")).filter("head < tail")
    steps = intervals.rate_spans(_intervals._schedule(spark, sf).withColumn("beat", C("beat") * 12), BY)
    rows = events(spark, sf, "click").select("series", beat("t", "beat"))
    marks = events(spark, sf, "purchase").select("series", beat("t", "t"), "id").groupBy("series", "t").agg(F.count("*").alias("n"))
    tempo = marks.withColumn("y", (C("t") + F.sum("n").over(Window.partitionBy("series").orderBy("t"))) / 600).select("series", "t", "y")
    return holds, steps, rows, tempo


def pinned_holds(spark, sf):
    """Which view spans the lattice tells from taps, and whose ends it places."""
    return op.pinned_holds(*pin_inputs(spark, sf), BY, 12, 0.05)


def watched(spark, sf):
    """The fifteen series with most jacks, short holds and pinned tails."""
    pinned = pinned_holds(spark, sf)
    notes = events(spark, sf).select("series", (C("k") % 5).alias("col"), (C("t") / HOUR).alias("t"))
    holds = spans(spark, sf).select("series", C("id").alias("hold"), (C("s") / HOUR).alias("head"), (C("e") / HOUR).alias("tail"))
    return op.watched(notes, holds, pinned, "series", 15, 24.0, 5.0)


def tile_inputs(spark, sf):
    tiles = intervals.tile(spans(spark, sf), 3 * HOUR, remain=15 * MINUTE, sliver=MINUTE).select("series", C("t0").cast("long").alias("t0"), C("t1").cast("long").alias("t1"))
    pins = events(spark, sf, "error").select("series", C("t").alias("t0"), (C("t") + (C("k") + 1) * 10 * MINUTE).alias("t1"), C("v").alias("value"), C("id").alias("rank"))
    return tiles, pins


def replace_tiles(spark, sf):
    """Tiles of view spans, with errors in place of what they overlap; later errors over earlier ones."""
    return op.replace_tiles(*tile_inputs(spark, sf), BY, 6 * HOUR, 1, 10 * MINUTE)


def heights(spark, sf):
    """How high the local maxima of each series' values rise."""
    out = op.local_heights(_signals._signal(spark, sf), BY)
    return out.select("series", "n", *(F.round(c, 6).alias(c) for c in ("low", "middle", "high")))


def tempo_inputs(spark, sf):
    rows = events(spark, sf).select("series", (C("v") + C("k") / 100).alias("t"))
    return rows, align.tempo_scan(rows, BY, spark.range(0, 41).select((60 + C("id") / 2).alias("bpm"))).select("series", "bpm")


def tempo_and_origin(spark, sf):
    """Values and cents as seconds: the tempo to 0.0005 round the one of the coarse scan, and where a beat falls."""
    rows, coarse = tempo_inputs(spark, sf)
    out = op.tempo_and_origin(rows, BY, coarse)
    return out.select("series", F.round("bpm", 6).alias("bpm"), F.round("strength", 6).alias("strength"), F.round("origin", 6).alias("origin"))


QUERIES = {"i10_pinned_holds": pinned_holds, "i10_watched": watched, "c6_replace_tiles": replace_tiles, "j1_heights": heights, "e7_tempo_and_origin": tempo_and_origin}

SQL = {
    "c6_replace_tiles": f"""WITH {EVENTS}, {SPANS('views', 'view', 20)}, n AS (SELECT *, greatest(0, CAST(ceil((e - s - {15 * MINUTE}) / {3 * HOUR}) AS BIGINT)) AS n FROM views), x AS (SELECT series, s, e, unnest(range(n)) AS k FROM n),
        t AS (SELECT series, s + k * {3 * HOUR} AS t0, least(s + (k + 1) * {3 * HOUR}, e) AS t1 FROM x WHERE least(s + (k + 1) * {3 * HOUR}, e) - s - k * {3 * HOUR} >= {MINUTE}),
        p AS (SELECT series, t AS t0, t + (k + 1) * {10 * MINUTE} AS t1, v, id FROM events_ WHERE kind = 'error')
        SELECT series, t0, t1, NULL::BIGINT AS pinned FROM t WHERE t1 - t0 >= {10 * MINUTE} AND NOT EXISTS (SELECT 1 FROM p WHERE p.series = t.series AND t.t1 > p.t0 + 1 AND t.t0 < p.t1 - 1)
        UNION ALL SELECT series, t0, t1, v FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.series = p.series AND q.id > p.id AND p.t1 > q.t0 + 1 AND p.t0 < q.t1 - 1)""",
    "j1_heights": f"""WITH {EVENTS}, f AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY t, id) AS frame FROM events_), r AS (SELECT series, frame, v - quantile_cont(v, 0.3) OVER (PARTITION BY series ORDER BY frame ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) AS r FROM f),
        m AS (SELECT *, lag(r) OVER w AS a, lead(r) OVER w AS b FROM r WINDOW w AS (PARTITION BY series ORDER BY frame))
        SELECT series, count(*) AS n, round(quantile_cont(r, 0.1), 6) AS low, round(quantile_cont(r, 0.5), 6) AS middle, round(quantile_cont(r, 0.9), 6) AS high FROM m WHERE r >= a AND r > b AND r > 5 GROUP BY series""",
}
