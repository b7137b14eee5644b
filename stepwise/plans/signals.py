"""Queries E1 to E9 and J1 to J9: a user's events as observed and declared series, and as frame signals."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import align
from ..operators import signals as op
from .adapters import EVENTS, HOUR, MINUTE, SPANS, events, spans

C, L = F.col, F.lit
BY = ["series"]


def _marks(spark, sf, kind):
    """Whole minutes, in columns of k % 2."""
    return events(spark, sf, kind).select("series", (C("k") % 2).alias("col"), F.floor(C("t") / MINUTE).alias("t")).distinct()


def offset_sweep(spark, sf):
    """Clicks against purchases: offsets of -600 to 600 minutes in steps of 20, within 30."""
    return align.offset_sweep(_marks(spark, sf, "click"), _marks(spark, sf, "purchase"), BY, "col", -600, 600, 20, 30)


def _offsets(spark):
    return spark.range(-12, 13).select((C("id") * HOUR).alias("offset"))


def fit_violation(spark, sf):
    anchors = events(spark, sf, "purchase").select("series", "t", (C("v") % 20).alias("cum"))
    return align.fit_violation(anchors, events(spark, sf, "click").select("series", "t"), _offsets(spark), BY)


def fit_two_sided(spark, sf):
    anchors = events(spark, sf, "purchase").select("series", "t", (C("v") % 5).alias("cum"))
    holds = spans(spark, sf, "view", 1).select("series", C("s").alias("ps"), C("e").alias("pe"))
    out = align.fit_two_sided(anchors, events(spark, sf, "click").select("series", "t"), holds, _offsets(spark), BY, 48 * HOUR, HOUR, 100 * HOUR, 10 * MINUTE, 3)
    return out.select("series", "offset", F.round("error", 6).alias("error"), "n")


def fit_zero(spark, sf):
    reads = events(spark, sf, "purchase").select("series", "t", (C("v") % 15).alias("v"))
    return align.fit_zero(reads, events(spark, sf, "click").select("series", "t"), _offsets(spark), BY, 0)


def fit_lattice(spark, sf):
    """Events in hours against a tempo map with a purchase every other beat."""
    hour = (C("t") - 1_704_067_200_000_000) / HOUR
    order = Window.partitionBy("series").orderBy("t")
    tempo = events(spark, sf, "purchase").groupBy("series", "t").agg(F.count("*").alias("n")).select("series", hour.alias("t"), (2 * F.row_number().over(order)).cast("double").alias("beat"))
    return align.fit_lattice(events(spark, sf).select("series", hour.alias("t")), tempo, BY, (1, 2, 3, 4), -1, 1, 0.05, 0.004)


def fit_clock(spark, sf):
    """One round of matching clicks to purchases within six hours, from the middle of the month."""
    at = lambda kind: events(spark, sf, kind).select("series", ((C("t") - 1_705_320_000_000_000) / HOUR).alias("t"))
    out = align.fit_clock(at("click"), at("purchase"), BY, 6.0, rounds=1, least=3)
    return out.select("series", F.round("slope", 5).alias("slope"), (F.round("intercept", 3) + 0.0).alias("intercept"), "n")


def tempo_scan(spark, sf):
    rows = events(spark, sf).select("series", (C("v") + C("k") / 100).alias("t"))
    tempi = spark.range(0, 41).select((60 + C("id") / 2).alias("bpm"))
    out = align.tempo_scan(rows, BY, tempi)
    return out.select("series", "bpm", F.round("strength", 6).alias("strength"), "elsewhere")


def rolling_drift(spark, sf):
    rows = events(spark, sf).select("series", "id", F.floor(C("t") / MINUTE).alias("t"))
    return align.rolling_drift(rows, BY, 3000, 60).select("series", "id", F.round("residual", 6).alias("residual"), F.round("drift", 6).alias("drift"))


def accrual_map(spark, sf):
    anchors = events(spark, sf, "purchase").select("series", "t", (C("v") % 20).alias("cum"))
    holds = spans(spark, sf, "view", 2).select("series", C("s").alias("ps"), C("e").alias("pe"))
    return align.accrual_map(anchors, events(spark, sf, "click").select("series", "t"), holds, BY, 48 * HOUR).select("series", "s", "e", "gain", "held")


def _signal(spark, sf):
    """Events numbered as frames, by user."""
    frame = F.row_number().over(Window.partitionBy("series").orderBy("t", "id"))
    return events(spark, sf).withColumn("frame", frame)


def rises(spark, sf):
    rows = op.rises(_signal(spark, sf), BY, "v", 50)
    return rows.select("series", "frame", F.round("rise", 6).alias("rise"))


def onsets(spark, sf):
    return op.onsets(_signal(spark, sf), BY, "v", 50, 12 * HOUR)


def occupancy_spans(spark, sf):
    return op.occupancy_spans(_signal(spark, sf), BY, "v", 120, 3)


def learned_floor(spark, sf):
    rows = events(spark, sf).select("series", "id", C("v").cast("double").alias("q"), C("k").alias("sat"))
    return op.learned_floor(rows, BY, 100, 200, 2.0, 20).select("series", "id", F.round("floor", 6).alias("floor"))


def track(spark, sf):
    return op.track(_signal(spark, sf).select("series", F.floor(C("frame") / 3).alias("frame"), "t", C("v").cast("double").alias("y")), BY, 120)


def fit_tracks(spark, sf):
    """Each user's days as tracks of value by hour."""
    rows = events(spark, sf).select("series", F.floor(C("t") / (96 * HOUR)).alias("track"), ((C("t") - 1_704_067_200_000_000) / HOUR).alias("t"), C("v").cast("double").alias("y"))
    out = op.fit_tracks(rows, ["series", "track"], 250, 4, -0.5)
    return out.select("series", "track", "n", F.round("v", 6).alias("v"), F.round("t", 4).alias("t"))


def _notes(spark, sf):
    return events(spark, sf).select("series", (C("k") % 4).alias("col"), "id", F.floor(C("t") / MINUTE).alias("t"), (C("k") % 9 + 1).alias("frames"), (C("v") + 100).cast("double").alias("v"))


def clean_notes(spark, sf):
    """Merged, without odd speeds and short streaks."""
    merged = op.merge_close(_notes(spark, sf).groupBy("series", "col", "t").agg(F.max("frames").alias("frames"), F.max("v").alias("v")), ["series", "col"], 600)
    return op.drop_short_streaks(op.drop_odd_speed(merged, BY, 0.6), BY, 4, 0.12, 300)


def merge_close(spark, sf):
    return op.merge_close(_notes(spark, sf).groupBy("series", "col", "t").agg(F.max("frames").alias("frames")), ["series", "col"], 600)


def mark_holds(spark, sf):
    notes = events(spark, sf, "click").select("series", F.floor(C("t") / MINUTE).alias("t")).distinct()
    rails = spans(spark, sf, "view", 2).select("series", F.floor(C("s") / MINUTE).alias("s"), F.floor(C("e") / MINUTE).alias("e"))
    return op.mark_holds(notes, rails, BY, 60, 300, 0.6)


def quantise(spark, sf):
    out = op.quantise(_notes(spark, sf), ["series", "col"], 28_401_120, 240, 2)
    return out.select("series", "col", "line", F.round("error", 6).alias("error"), "t")


def min_gap_filter(spark, sf):
    return op.min_gap_filter(_notes(spark, sf), ["series", "col"], 400, ("t", "id")).select("id")


QUERIES = {
    "e1_offset_sweep": offset_sweep, "e2_fit_violation": fit_violation, "e3_fit_two_sided": fit_two_sided, "e4_fit_zero": fit_zero, "e5_fit_lattice": fit_lattice, "e6_fit_clock": fit_clock, "e7_tempo_scan": tempo_scan, "e8_rolling_drift": rolling_drift,
    "e9_accrual_map": accrual_map, "j1_rises": rises, "j1_onsets": onsets, "j2_occupancy_spans": occupancy_spans, "j3_learned_floor": learned_floor, "j4_track": track, "j5_fit_tracks": fit_tracks, "j6_merge_close": merge_close, "j6_clean_notes": clean_notes,
    "j7_mark_holds": mark_holds, "j8_quantise": quantise, "j9_min_gap_filter": min_gap_filter,
}

_M = "a AS (SELECT DISTINCT series, k % 2 AS c, t // 60000000 AS t FROM events_ WHERE kind = 'click'), b AS (SELECT DISTINCT series, k % 2 AS c, t // 60000000 AS t FROM events_ WHERE kind = 'purchase')"
_O = f"o AS (SELECT range * {HOUR} AS o FROM range(-12, 13))"
_N = "n0 AS (SELECT series, k % 4 AS col, id, t // 60000000 AS t, k % 9 + 1 AS frames FROM events_)"
_F = "f AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY t, id) AS frame FROM events_)"
_TAPS = "(SELECT count(*) FROM events_ c WHERE c.kind = 'click' AND c.series = {s} AND c.t <= {t})"

SQL = {
    "e1_offset_sweep": f"WITH {EVENTS}, {_M}, o AS (SELECT range AS o FROM range(-600, 601, 20)), h AS (SELECT a.series, o, a.c, a.t, min(b.t) AS r FROM a JOIN o ON true JOIN b ON a.series = b.series AND a.c = b.c AND b.t >= a.t + o - 30 GROUP BY ALL), s AS (SELECT series, o, count(*) AS hits, quantile_cont(abs(r - t - o), 0.5) AS e FROM h WHERE r <= t + o + 30 GROUP BY ALL) SELECT series, o AS \"offset\", hits, e AS error FROM s QUALIFY row_number() OVER (PARTITION BY series ORDER BY hits DESC, e, o) = 1",
    "e2_fit_violation": f"WITH {EVENTS}, {_O}, g AS (SELECT series, t, v % 20 AS cum, o, v % 20 - {_TAPS.format(s='e.series', t='e.t - o')} AS k FROM events_ e, o WHERE kind = 'purchase'), m AS (SELECT *, max(k) OVER (PARTITION BY series, o ORDER BY t, cum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM g), s AS (SELECT series, o, CAST(sum(greatest(-k, 0) + greatest(greatest(coalesce(top, -1), -1) - k, 0)) AS BIGINT) AS score FROM m GROUP BY ALL) SELECT series, o AS \"offset\", score FROM s QUALIFY row_number() OVER (PARTITION BY series ORDER BY score, o) = 1",
    "e3_fit_two_sided": f"WITH {EVENTS}, {SPANS('h', 'view', 1)}, {_O}, p AS (SELECT series, t AS s, lead(t) OVER w AS e, lead(v % 5) OVER w - v % 5 AS d FROM events_ WHERE kind = 'purchase' WINDOW w AS (PARTITION BY series ORDER BY t, v % 5)), q AS (SELECT series, s - o AS s, e - o AS e, d, o FROM p, o WHERE e - s BETWEEN {HOUR} AND {100 * HOUR} AND d >= 0 AND s >= o), r AS (SELECT series, o, abs(d - (SELECT count(*) FROM events_ c WHERE c.kind = 'click' AND c.series = q.series AND c.t > q.s AND c.t <= q.e)) AS x FROM q WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.series = q.series AND q.s - {10 * MINUTE} < h.e AND h.s < q.e + {10 * MINUTE})), g AS (SELECT series, o, avg(x) AS error, count(*) AS n FROM r GROUP BY ALL HAVING count(*) >= 3) SELECT series, o AS \"offset\", round(error, 6) AS error, n FROM g QUALIFY row_number() OVER (PARTITION BY series ORDER BY round(error, 9), o) = 1",
    "e4_fit_zero": f"WITH {EVENTS}, {_O}, g AS (SELECT series, o, count(*) FILTER (v % 15 = {_TAPS.format(s='e.series', t='e.t - o')}) AS z FROM events_ e, o WHERE kind = 'purchase' GROUP BY ALL) SELECT series, o AS \"offset\", z AS zeros FROM g QUALIFY row_number() OVER (PARTITION BY series ORDER BY z DESC, o) = 1",
    "e6_fit_clock": f"WITH {EVENTS}, a AS (SELECT series, (t - 1705320000000000) / {HOUR} AS t FROM events_ WHERE kind = 'click'), b AS (SELECT series, (t - 1705320000000000) / {HOUR} AS r FROM events_ WHERE kind = 'purchase'), p AS (SELECT b.series, r, a.t FROM b JOIN a ON a.series = b.series QUALIFY row_number() OVER (PARTITION BY b.series, r ORDER BY abs(a.t - r), a.t) = 1), g AS (SELECT series, regr_slope(t, r) AS k, avg(r) AS x, avg(t) AS y, count(*) AS n FROM p WHERE abs(t - r) <= 6 GROUP BY 1), c AS (SELECT *, greatest(0.99, least(1.01, coalesce(k, 1))) AS s, n >= 3 AS ok FROM g) SELECT u.series, round(CASE WHEN ok THEN s ELSE 1 END, 5) AS slope, round(CASE WHEN ok THEN y - s * x ELSE 0 END, 3) + 0.0 AS intercept, CASE WHEN ok THEN n ELSE 0 END AS n FROM (SELECT DISTINCT series FROM a) u LEFT JOIN c ON u.series = c.series",
    "e7_tempo_scan": f"WITH {EVENTS}, b AS (SELECT 60 + range / 2 AS bpm FROM range(41)), g AS (SELECT series, bpm, round(sqrt(avg(cos({2 * math.pi} * (v + k / 100) * bpm * 12 / 60)) ** 2 + avg(sin({2 * math.pi} * (v + k / 100) * bpm * 12 / 60)) ** 2), 9) AS s FROM events_, b GROUP BY ALL), t AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY series ORDER BY s DESC, bpm) = 1), e AS (SELECT g.series, g.bpm FROM g JOIN t ON g.series = t.series AND abs(g.bpm - t.bpm) > 0.5 QUALIFY row_number() OVER (PARTITION BY g.series ORDER BY g.s DESC, g.bpm) = 1) SELECT t.series, t.bpm, round(t.s, 6) AS strength, e.bpm AS elsewhere FROM t LEFT JOIN e ON t.series = e.series",
    "e8_rolling_drift": f"WITH {EVENTS}, r AS (SELECT series, id, t // 60000000 AS t, t // 60000000 - round((t // 60000000) / 60) * 60 AS r FROM events_) SELECT series, id, round(r, 6) AS residual, round(quantile_cont(r, 0.5) OVER (PARTITION BY series ORDER BY t RANGE BETWEEN 3000 PRECEDING AND 3000 FOLLOWING), 6) AS drift FROM r",
    "e9_accrual_map": f"WITH {EVENTS}, {SPANS('h', 'view', 2)}, k AS (SELECT series, t, v % 20 AS cum, v % 20 - {_TAPS.format(s='e.series', t='e.t')} AS k FROM events_ e WHERE kind = 'purchase'), m AS (SELECT *, max(k) OVER (PARTITION BY series ORDER BY t, cum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top, lag(t) OVER (PARTITION BY series ORDER BY t, cum) AS s FROM k) SELECT series, s, t AS e, k - top AS gain, EXISTS (SELECT 1 FROM h WHERE h.series = m.series AND m.s < h.e AND h.s < m.t) AS held FROM m WHERE k > top",
    "j1_rises": f"WITH {EVENTS}, {_F}, r AS (SELECT series, frame, v - quantile_cont(v, 0.3) OVER (PARTITION BY series ORDER BY frame ROWS 30 PRECEDING) AS rise, count(*) OVER (PARTITION BY series) AS n FROM f), m AS (SELECT *, max(rise) OVER (PARTITION BY series ORDER BY frame ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS top FROM r) SELECT series, frame, round(rise, 6) AS rise FROM m WHERE rise = top AND rise > 50 AND frame > 4 AND frame <= n - 4",
    "j2_occupancy_spans": f"WITH {EVENTS}, {_F}, o AS (SELECT series, frame, CASE WHEN frame - lag(frame) OVER (PARTITION BY series ORDER BY frame) <= 4 THEN 0 ELSE 1 END AS new FROM f WHERE v >= 120), g AS (SELECT *, sum(new) OVER (PARTITION BY series ORDER BY frame) AS run FROM o) SELECT series, min(frame) AS f0, max(frame) AS f1, count(*) AS frames FROM g GROUP BY series, run HAVING max(frame) - min(frame) >= 2",
    "j3_learned_floor": f"WITH {EVENTS}, p AS (SELECT series, CASE WHEN count(*) FILTER (v >= 200) >= 20 THEN 2 * quantile_cont(k, 0.1) FILTER (v >= 200) ELSE 0 END AS f FROM events_ GROUP BY 1) SELECT e.series, id, round(f, 6) AS floor FROM events_ e JOIN p ON e.series = p.series WHERE v >= 100 AND k >= f",
    "j5_fit_tracks": f"WITH {EVENTS}, r AS (SELECT series, t // {96 * HOUR} AS track, (t - 1704067200000000) / {HOUR} AS t, v AS y FROM events_), g AS (SELECT series, track, count(*) AS n, regr_slope(y, t) AS k, avg(t) AS mt, avg(y) AS my FROM r GROUP BY ALL) SELECT series, track, n, round(k, 6) AS v, round(mt + (250 - my) / k, 4) AS t FROM g WHERE n >= 4 AND k <= -0.5",
    "j6_merge_close": f"WITH {EVENTS}, {_N}, u AS (SELECT series, col, t, max(frames) AS frames FROM n0 GROUP BY ALL), m AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY series, col ORDER BY t) < 600 THEN 0 ELSE 1 END AS new FROM u), g AS (SELECT *, sum(new) OVER (PARTITION BY series, col ORDER BY t) AS run FROM m) SELECT series, col, t, frames FROM g QUALIFY row_number() OVER (PARTITION BY series, col, run ORDER BY frames DESC, t) = 1",
    "j7_mark_holds": f"WITH {EVENTS}, {SPANS('v', 'view', 2)}, n AS (SELECT DISTINCT series, t // 60000000 AS t FROM events_ WHERE kind = 'click'), r AS (SELECT DISTINCT series, s // 60000000 AS s, e // 60000000 AS e FROM v), c AS (SELECT r.series, s, e, n.t FROM r JOIN n ON r.series = n.series QUALIFY row_number() OVER (PARTITION BY r.series, s, e ORDER BY abs(n.t - s), n.t) = 1), k AS (SELECT series, t, max(e) AS hold_end FROM c WHERE abs(t - s) <= least(300, greatest(60, 0.6 * (e - s))) GROUP BY ALL), x AS (SELECT n.series, n.t, k.hold_end, p.hold_end AS pe FROM n LEFT JOIN k ON n.series = k.series AND n.t = k.t ASOF LEFT JOIN k p ON n.series = p.series AND n.t > p.t) SELECT series, t, hold_end FROM x WHERE pe IS NULL OR t > pe OR hold_end IS NOT NULL",
    "j8_quantise": f"WITH {EVENTS}, {_N}, x AS (SELECT series, col, t, (t - 28401120) / 240 * 2 AS x FROM n0), e AS (SELECT series, col, t, CAST(round(x) AS BIGINT) AS line, abs(x - round(x)) * 2 AS e FROM x) SELECT series, col, line, round(e, 6) AS error, t FROM e WHERE e < 0.7 QUALIFY row_number() OVER (PARTITION BY series, col, line ORDER BY round(e, 9), t) = 1",
    "j9_min_gap_filter": f"WITH {EVENTS}, {_N}, g AS (SELECT id, t - lag(t) OVER (PARTITION BY series, col ORDER BY t, id) AS g FROM n0) SELECT id FROM g WHERE g IS NULL OR g >= 400",
}
