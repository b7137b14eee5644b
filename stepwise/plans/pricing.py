"""Queries of the pricing operators: G3, G9 and G14 in full."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import intervals, pricing
from ..operators import pricing as op
from ..operators._range import count_at
from . import intervals as _intervals
from .adapters import EVENTS, HOUR, MINUTE, SPANS, events, spans

BY = ["series"]
C = F.col
#: near, reach and edge of the observed holds, span and jitter of the prices.
OBSERVE = (2 * HOUR, 24 * HOUR, HOUR, 0.3)
PRICE = (60 * HOUR, MINUTE, 2, 0.4)


def _disjoint(spark, sf, kind, minutes):
    """Spans of a kind, cut short a second before the next."""
    order = Window.partitionBy("series").orderBy("s", "id")
    rows = spans(spark, sf, kind, minutes).withColumn("n", F.lead("s").over(order))
    return rows.withColumn("e", F.least("e", F.coalesce(C("n") - 1_000_000, C("e")))).filter("s < e").drop("n")


def hold_inputs(spark, sf):
    """Click spans as regions, purchases as anchors of an hour, all events as reads of the number of clicks so far, errors as taps."""
    clicks = events(spark, sf, "click").select("series", "t")
    reads = count_at(clicks, events(spark, sf), BY, "t", "t", "n").select("series", "t", F.when(C("k") != 7, C("n") + F.floor(C("k") / 25)).cast("long").alias("v"), "conf")
    anchors = count_at(clicks, events(spark, sf, "purchase"), BY, "t", "t", "n").filter("k < 50").select("series", C("t").alias("t0"), (C("t") + HOUR).alias("t1"), C("n").cast("long").alias("v"))
    regions = _disjoint(spark, sf, "click", 3).select("series", C("id").alias("region"), "s", "e")
    return regions, anchors, reads, events(spark, sf, "error").select("series", "t")


def read_holds(spark, sf):
    """What each region is seen to count, and from what."""
    out = op.read_holds(*hold_inputs(spark, sf), BY, *OBSERVE)
    return out.withColumn("lo", C("lo").cast("long")).withColumn("hi", C("hi").cast("long"))


def remainders(spark, sf):
    """What the regions that can't be pinned must count together."""
    regions, anchors, reads, taps = hold_inputs(spark, sf)
    judged = events(spark, sf).groupBy("series").agg(F.count("*").alias("judged"))
    return op.remainders(op.read_holds(regions, anchors, reads, taps, BY, *OBSERVE), taps, judged, BY)


def play_inputs(spark, sf):
    """View spans as regions, clicks as taps, all events as reads of the clicks so far and a little more; every second series is a clean play."""
    regions = _disjoint(spark, sf, "view", 4).select("series", "s", "e", (C("id") % 4).alias("ticks"))
    taps = events(spark, sf, "click").select("series", "t")
    run = F.floor(C("t") / (600 * HOUR))
    reads = count_at(taps, events(spark, sf).filter("kind <> 'click'"), BY, "t", "t", "n").select("series", "t", (C("n") + F.floor(C("k") / 34)).cast("long").alias("v"), run.alias("run"))
    plays = events(spark, sf).groupBy("series").agg(F.count("*").alias("n")).select("series", (C("series") % 2 == 0).alias("clean"), F.lit(60).cast("long").alias("tol"), F.when(C("series") % 3 != 0, C("n")).alias("judged"))
    return regions, taps, reads, plays


def price_plays(spark, sf):
    """Regions priced by the reads around them, with each refusal."""
    return op.price_plays(*play_inputs(spark, sf), BY, *PRICE)


def lattice_inputs(spark, sf):
    """The inputs of the lattice count, and targets a little off what it gives."""
    beat = lambda c: (F.floor(C(c) / (5 * MINUTE)) - 473_400 * 12).alias(c)
    holds = spans(spark, sf).select("series", beat("s").alias("head"), beat("e").alias("tail"))
    steps = intervals.rate_spans(_intervals._schedule(spark, sf).withColumn("beat", C("beat") * 12), BY).checkpoint()  # this and what is counted are read many times
    excluded = spans(spark, sf, "error", 3).select("series", beat("s"), beat("e"))
    rows = events(spark, sf, "click").select("series", beat("t").alias("beat"))
    counted = intervals.lattice_count(holds, steps, excluded, rows, BY, 12, 144).checkpoint()
    targets = counted.select("series", "region", (C("events") + (C("series") * 7 + C("region") * 5) % 19 - 4).alias("target")).filter("target >= 0")
    return counted, targets, steps, excluded, rows, holds


def rate_scan(spark, sf):
    """What each region off its target counts at every rate of the scan."""
    out = pricing.rate_counts(*lattice_inputs(spark, sf), BY, 12, 144)
    return out.select("series", "b0", "b1", "target", F.explode("scan").alias("x")).select("series", "b0", "b1", "target", "x.rate", "x.n")


def land_regions(spark, sf):
    """The rates at which each of these regions counts its target."""
    return pricing.land_regions(*lattice_inputs(spark, sf), BY, 12, 144)


QUERIES = {"g3_read_holds": read_holds, "g3_remainders": remainders, "g9_price_plays": price_plays, "g14_rate_scan": rate_scan, "g14_land_regions": land_regions}

_BEAT = f"{5 * MINUTE}) - 5680800 AS BIGINT)"
SQL = {
    "g14_rate_scan": f"""WITH base AS ({_intervals.SQL["c14_lattice_count"]}), {EVENTS}, {SPANS('views', 'view', 20)}, {SPANS('errs', 'error', 3)}, {_intervals._SCHED},
        h AS (SELECT DISTINCT series, CAST(floor(s / {_BEAT} AS beat FROM views), x AS (SELECT series, CAST(floor(s / {_BEAT} AS s, CAST(floor(e / {_BEAT} AS e FROM errs),
        b AS (SELECT DISTINCT series, CAST(floor(t / {_BEAT} AS beat FROM events_ WHERE kind = 'click' UNION SELECT * FROM h),
        n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY b0) - 1 AS region FROM base), o AS (SELECT *, events + (series * 7 + region * 5) % 19 - 4 AS target FROM n WHERE b1 > b0),
        e AS (SELECT o.*, value AS last FROM o ASOF LEFT JOIN (SELECT series, b0 * 12 AS f, value FROM steps) s ON o.series = s.series AND o.b1 >= s.f WHERE target >= 0 AND target <> events),
        f AS (SELECT *, heads + CASE WHEN last > 0 AND b1 * last % 12 = 0 AND NOT EXISTS (SELECT 1 FROM x WHERE x.series = e.series AND e.b1 >= x.s AND e.b1 < x.e) AND NOT EXISTS (SELECT 1 FROM b WHERE b.series = e.series AND b.beat = e.b1) THEN 1 ELSE 0 END AS fixed FROM e),
        r AS (SELECT *, unnest(range(CAST(floor(24 * target / (b1 - b0)) AS BIGINT) + 13)) AS rate FROM f),
        p AS (SELECT series, region, rate, unnest(range(b0 * rate // 12, b1 * rate // 12 + 1)) AS k, b0, b1 FROM r WHERE rate > 0),
        g AS (SELECT series, region, rate, k * 12 / rate AS p FROM p WHERE k * 12 > b0 * rate AND k * 12 < b1 * rate),
        c AS (SELECT series, region, rate, count(*) AS n FROM g WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.series = g.series AND g.p >= x.s AND g.p < x.e) AND NOT EXISTS (SELECT 1 FROM b WHERE b.series = g.series AND b.beat = g.p) GROUP BY ALL)
        SELECT r.series, b0, b1, target, r.rate, fixed + coalesce(c.n, 0) AS n FROM r LEFT JOIN c ON r.series = c.series AND r.region = c.region AND r.rate = c.rate""",
}
