"""Interval and step-function algebra.

Ends: counts are over (lo, hi]; exclusions are [s, e); holds are (head, tail];
intervals that touch within `eps` merge. `by` names the key of a series.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._range import asof, count_at, nearest, overlap_join

EPS = 1e-6


def pair_holds(notes: DataFrame, by: Sequence[str] = ("series", "col"), at: str = "t", sym: str = "sym") -> DataFrame:
    """by, head, tail: each tail ('3') closes the latest open head ('2') of its column; a second head replaces it; orphan tails are ignored."""
    order = Window.partitionBy(*by).orderBy(at, sym)
    ends = notes.filter(F.col(sym).isin("2", "3")).select(*by, F.col(at).alias("head"), F.col(sym).alias("_s"), F.lead(at).over(order).alias("tail"), F.lead(sym).over(order).alias("_n"))
    return ends.filter("_s = '2' AND _n = '3'").drop("_s", "_n")


def number_regions(df: DataFrame, by: Sequence[str], start: str = "s", end: str = "e", eps: float = EPS) -> DataFrame:
    """df with region: 0, 1, ... in each key, for intervals that overlap or touch within eps."""
    order = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(start) > before + eps), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("region", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_new")


def union_intervals(df: DataFrame, by: Sequence[str], start: str = "s", end: str = "e", eps: float = EPS) -> DataFrame:
    """by, region, start, end, n: the regions that the intervals cover."""
    return number_regions(df, by, start, end, eps).groupBy(*by, "region").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"))


def cluster_by_gap(df: DataFrame, by: Sequence[str], at: str, gap: float, end: str | None = None) -> DataFrame:
    """df with cluster: a new one where the distance to the previous row (with `end`: to the furthest end so far) is over gap."""
    if end is not None:
        return number_regions(df, by, at, end, gap).withColumnRenamed("region", "cluster")
    order = Window.partitionBy(*by).orderBy(at)
    new = F.when(F.col(at) - F.lag(at).over(order) <= gap, 0).otherwise(1)
    return df.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, 0)) - 1).drop("_new")


def cluster_price(rails: DataFrame, by: Sequence[str], start: str = "s", end: str = "e", price: str = "price", cause: str = "cause", eps: float = EPS) -> DataFrame:
    """by, region, start, end, n, price (the largest of its members, null if none has one), cause (of a region without price: the commonest, then the smallest)."""
    rows = number_regions(rails, by, start, end, eps)
    causes = rows.filter(F.col(price).isNull() & F.col(cause).isNotNull()).groupBy(*by, "region", cause).agg(F.count("*").alias("_n"))
    first = Window.partitionBy(*by, "region").orderBy(F.desc("_n"), cause)
    common = causes.withColumn("_k", F.row_number().over(first)).filter("_k = 1").select(*by, "region", F.col(cause).alias("_cause"))
    priced = rows.groupBy(*by, "region").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"), F.max(price).alias(price))
    return priced.join(common, [*by, "region"], "left").withColumn(cause, F.when(F.col(price).isNull(), F.col("_cause"))).drop("_cause")


def interpolate(points: DataFrame, queries: DataFrame, by: Sequence[str], at: str = "t", value: str = "y", outside: str = "clamp", bucket: int | None = None) -> DataFrame:
    """queries with value on the piecewise line through points (one for each instant).

    Outside the points: `clamp` to the end's value, `extend` the end's slope, `unit`
    slope, or `origin` (scale from the origin through the end). Null without points.
    """
    order = Window.partitionBy(*by).orderBy(at)
    slope = (F.lead(value).over(order) - F.col(value)) / (F.lead(at).over(order) - F.col(at))
    lines = points.select(*by, F.col(at).alias(at), F.col(at).cast("double").alias("_t"), F.col(value).cast("double").alias("_y"), slope.alias("_m"), F.lag(value).over(order).alias("_py"), F.lag(at).over(order).alias("_pt"))
    lines = lines.withColumn("_k", F.coalesce("_m", (F.col("_y") - F.col("_py")) / (F.col("_t") - F.col("_pt")), F.lit(0.0)))
    lines = lines.withColumn("_open", F.col("_m").isNull())
    got = asof(queries, lines, by, at, ["_t", "_y", "_k", "_open"], bucket=bucket)
    head = lines.groupBy(*by).agg(F.min_by(F.struct("_t", "_y", "_k"), "_t").alias("_h"))
    got = got.join(head, list(by), "left")
    t, in_ = F.col(at), F.col("_t").isNotNull()
    base_t, base_y = F.coalesce("_t", "_h._t"), F.coalesce("_y", "_h._y")
    out = ~in_ | (F.col("_open") & (t > F.col("_t")))
    k = F.when(in_, F.col("_k")).otherwise(F.col("_h._k"))
    beyond = {"clamp": base_y, "extend": base_y + k * (t - base_t), "unit": base_y + (t - base_t), "origin": t * base_y / base_t}[outside]
    return got.withColumn(value, F.when(out, beyond).otherwise(base_y + k * (t - base_t))).drop("_t", "_y", "_k", "_open", "_h")


def tile(spans: DataFrame, width: float, start: str = "s", end: str = "e", remain: float = 0.25, sliver: float = 0.2) -> DataFrame:
    """spans exploded to tile, t0, t1: steps of width while more than `remain` is left; the last ends with the span; slivers are dropped."""
    n = F.greatest(F.lit(0), F.ceil((F.col(end) - F.col(start) - remain) / width)).cast("int")
    tiles = spans.withColumn("_n", n).filter("_n > 0").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    tiles = tiles.withColumn("t0", F.col(start) + F.col("tile") * width)
    return tiles.withColumn("t1", F.least(F.col("t0") + width, F.col(end))).filter(F.col("t1") - F.col("t0") >= sliver)


def tile_snapped(spans: DataFrame, holds: DataFrame, by: Sequence[str], width: float, remain: float = 0.25, sliver: float = 0.2) -> DataFrame:
    """by, t0, t1: tiles of spans(by, s, e) whose inner edges, where they fall inside a hold(by, head, tail), move to its nearer end.

    Each edge follows from the one before, so this runs series by series.
    """
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spans.select(*by).schema.fields)

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        held = sorted(zip(right["head"], right["tail"], strict=True))
        rows = []
        for s, e in sorted(zip(left["s"], left["e"], strict=True)):
            at = s
            while e - at > remain:
                to = min(at + width, e)
                if to < e:
                    for a, b in held:
                        if a < to < b:
                            to = a if to - a <= b - to and a > at else b
                            break
                to = min(to, e)
                if to - at >= sliver:
                    rows.append((*key, at, to))
                at = to
        return pd.DataFrame(rows, columns=[*by, "t0", "t1"])

    return spans.groupBy(*by).cogroup(holds.groupBy(*by)).applyInPandas(run, f"{keys}, t0 double, t1 double")


def assign_by_overlap(segments: DataFrame, regions: DataFrame, by: Sequence[str], width: float, segment: str = "segment", region: str = "region") -> DataFrame:
    """segments(by, segment, s, e) with region and overlap: the region(by, region, rs, re) that overlaps most (ties: the smaller name), else the one with the nearest edge, overlap 0."""
    pairs = overlap_join(segments, regions, by, ("s", "e"), ("rs", "re"), width)
    over = F.least("e", "re") - F.greatest("s", "rs")
    best = pairs.withColumn("overlap", over).groupBy(*by, segment).agg(F.min_by(F.struct("overlap", region), F.struct(-F.col("overlap"), F.col(region))).alias("_best"))
    rest = segments.join(best, [*by, segment], "left").withColumn("_m", (F.col("s") + F.col("e")) / 2)
    edges = regions.select(*by, F.explode(F.array("rs", "re")).alias("_m"), F.col(region).alias("_r")).groupBy(*by, "_m").agg(F.min("_r").alias("_r"))
    near = nearest(rest, edges, by, "_m", "_edge").join(edges.select(*by, F.col("_m").alias("_edge"), "_r"), [*by, "_edge"], "left")
    return near.select(*segments.columns, F.coalesce(F.col(f"_best.{region}"), F.col("_r")).alias(region), F.coalesce(F.col("_best.overlap"), F.lit(0)).alias("overlap"))


def split_by_overlap(windows: DataFrame, regions: DataFrame, by: Sequence[str], width: float, window: str = "window", region: str = "region", value: str = "value") -> DataFrame:
    """by, window, region, share: value split over the regions that a window overlaps, in proportion; a window that covers nothing has a null region and share."""
    pairs = overlap_join(windows, regions, by, ("s", "e"), ("rs", "re"), width).withColumn("_o", F.least("e", "re") - F.greatest("s", "rs"))
    total = F.sum("_o").over(Window.partitionBy(*by, window))
    shares = pairs.select(*by, window, region, (F.col(value) * F.col("_o") / total).alias("share"))
    return windows.select(*by, window).join(shares, [*by, window], "left")


def overlap_filter(df: DataFrame, spans: DataFrame, by: Sequence[str], width: float, pad: float = 0, keep: str = "without") -> DataFrame:
    """Rows of df(by, s, e, ...) without any span(by, ps, pe) that overlaps [s - pad, e + pad]; keep='with' for those with one, 'count' for all with n_spans."""
    ids = [F.col(c) for c in df.columns]
    key = df.withColumn("_id", F.xxhash64(*ids)).withColumn("_a", F.col("s") - pad).withColumn("_b", F.col("e") + pad)
    hits = overlap_join(key.select(*by, "_id", "_a", "_b").distinct(), spans.select(*by, F.col("ps"), F.col("pe")), by, ("_a", "_b"), ("ps", "pe"), width)
    n = hits.groupBy(*by, "_id").agg(F.count("*").alias("n_spans"))
    if keep == "count":
        return key.join(n, [*by, "_id"], "left").withColumn("n_spans", F.coalesce("n_spans", F.lit(0))).select(*df.columns, "n_spans")
    return key.join(n, [*by, "_id"], "left_anti" if keep == "without" else "left_semi").select(*df.columns)


def count_between(points: DataFrame, queries: DataFrame, by: Sequence[str], point: str = "t", lo: str = "lo", hi: str = "hi", out: str = "n", bucket: int | None = None) -> DataFrame:
    """queries with the number of points in (lo, hi]."""
    below = count_at(points, queries, by, point, lo, "_below", bucket)
    both = count_at(points, below, by, point, hi, "_upto", bucket)
    return both.withColumn(out, F.col("_upto") - F.col("_below")).drop("_below", "_upto")


def rate_spans(schedule: DataFrame, by: Sequence[str], beat: str = "beat", value: str = "value", pos: str = "pos", initial: float = 1) -> DataFrame:
    """by, b0, b1, value: the step function of a schedule; `initial` before its first entry (from 0), negative beats dropped, the later of two entries on a beat wins, the last span is open (b1 null)."""
    rows = schedule.filter(F.col(beat) >= 0).groupBy(*by, beat).agg(F.max_by(value, pos).alias("value"))
    first = rows.groupBy(*by).agg(F.min(beat).alias("_f")).filter("_f > 0").select(*by, F.lit(0).cast(rows.schema[beat].dataType).alias(beat), F.lit(initial).cast(rows.schema["value"].dataType).alias("value"))
    order = Window.partitionBy(*by).orderBy(beat)
    return rows.unionByName(first).select(*by, F.col(beat).alias("b0"), F.lead(beat).over(order).alias("b1"), "value")


def spans_where(spans: DataFrame, by: Sequence[str], predicate: Column) -> DataFrame:
    """by, b0, b1: where the step value meets the predicate, adjacent spans joined; the last may be open."""
    order = Window.partitionBy(*by).orderBy("b0")
    rows = spans.withColumn("_in", F.coalesce(predicate, F.lit(False)))
    rows = rows.withColumn("_run", F.sum(F.when(F.col("_in") != F.coalesce(F.lag("_in").over(order), ~F.col("_in")), 1).otherwise(0)).over(order)).filter("_in")
    last = F.max_by("b1", "b0")
    return rows.groupBy(*by, "_run").agg(F.min("b0").alias("b0"), last.alias("b1")).drop("_run")


def patch_steps(schedule: DataFrame, patch: DataFrame, by: Sequence[str], beat: str = "beat", value: str = "value") -> DataFrame:
    """schedule with [b0, b1) of patch(by, b0, b1, rate) overwritten, and the value that held at b1 restored there.

    Patches of a series must not overlap; a series without an earlier entry gets 1 back.
    """
    restored = asof(patch.select(*by, F.col("b1").alias(beat)), schedule.withColumn("_v", F.col(value)), by, beat, ["_v"])
    restored = restored.select(*by, beat, F.coalesce("_v", F.lit(1).cast(schedule.schema[value].dataType)).alias(value))
    own = asof(schedule, patch.select(*by, F.col("b0").alias(beat), F.col("b1").alias("_to")), by, beat, ["_to"])
    keep = own.filter(F.col("_to").isNull() | (F.col(beat) > F.col("_to"))).select(*by, beat, value)
    starts = patch.select(*by, F.col("b0").alias(beat), F.col("rate").cast(schedule.schema[value].dataType).alias(value))
    abutting = restored.join(starts.select(*by, beat), [*by, beat], "left_anti")
    return keep.unionByName(starts).unionByName(abutting)


def lattice_count(holds: DataFrame, spans: DataFrame, excluded: DataFrame, rows: DataFrame, by: Sequence[str], unit: int, width: int) -> DataFrame:
    """by, region, b0, b1, heads, ticks, events: what a region of holds is judged to count.

    All beats are whole numbers of 1/unit beat, so every comparison is exact. Points
    are the multiples of 1/rate. holds(by, head, tail) merge to regions; spans(by, b0,
    b1, value) give the rate in force; excluded(by, s, e) are [s, e), merged here;
    rows(by, beat) are the tap rows. heads: head rows that are no tap row, whatever the
    rate. ticks: points in (head, tail] of the region, not excluded, and not on a tap
    row or a head row. Counts are closed-form (floor and ceiling divisions).
    """
    end = F.lit(1 << 40)
    regions = union_intervals(holds, by, "head", "tail", 0).select(*by, "region", F.col("head").alias("lo"), F.col("tail").alias("hi"))
    merged = union_intervals(excluded, by, "s", "e", 0).select(*by, "s", "e")
    steps = spans.select(*by, F.col("b0").alias("f"), F.coalesce("b1", end).alias("to"), "value")
    # a step may be far longer than a bin: only its part inside regions is binned
    pieces = regions.join(steps, list(by)).filter("f <= hi AND to > lo AND value > 0")
    at_most = lambda x: F.floor(x * F.col("value") / unit)
    below = lambda x: F.ceil(x * F.col("value") / unit) - 1
    upper, lower = F.least(at_most(F.col("hi")), below(F.col("to"))), F.greatest(at_most(F.col("lo")), below(F.col("f")))
    plain = pieces.withColumn("_n", F.greatest(F.lit(0), upper - lower))
    cut = overlap_join(pieces.select(*by, "region", "lo", "hi", "f", "to", "value"), merged, by, ("lo", "hi"), ("s", "e"), width, closed=True)
    up = F.least(at_most(F.col("hi")), below(F.col("to")), below(F.col("e")))
    down = F.greatest(at_most(F.col("lo")), below(F.col("f")), below(F.col("s")))
    lost = cut.withColumn("_n", -F.greatest(F.lit(0), up - down))
    points = plain.select(*by, "region", "_n").unionByName(lost.select(*by, "region", "_n"))

    taps = rows.select(*by, "beat").distinct()
    heads = holds.select(*by, F.col("head").alias("beat")).distinct()
    clear = lambda df: overlap_filter(df.withColumn("s", F.col("beat")).withColumn("e", F.col("beat")), merged.select(*by, F.col("s").alias("ps"), (F.col("e") - 1).alias("pe")), by, width, 0.5).drop("s", "e")
    lone = clear(heads.join(taps, [*by, "beat"], "left_anti"))
    judged = clear(taps.unionByName(heads).distinct())
    inside = overlap_join(judged.withColumn("_p", F.col("beat")), regions, by, ("beat", "_p"), ("lo", "hi"), width, closed=True).filter("beat > lo").drop("_p")
    taken = asof(inside, spans.select(*by, F.col("b0").alias("beat"), F.col("value").alias("_rate")), by, "beat", ["_rate"]).filter((F.col("_rate") > 0) & ((F.col("beat") * F.col("_rate")) % unit == 0))
    points = points.unionByName(taken.select(*by, "region", F.lit(-1).alias("_n")))
    head_n = overlap_join(lone.withColumn("_p", F.col("beat")), regions, by, ("beat", "_p"), ("lo", "hi"), width, closed=True).groupBy(*by, "region").agg(F.count("*").alias("heads"))
    ticks = points.groupBy(*by, "region").agg(F.sum("_n").alias("ticks"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = regions.join(head_n, [*by, "region"], "left").join(ticks, [*by, "region"], "left").select(*by, "region", F.col("lo").alias("b0"), F.col("hi").alias("b1"), zero("heads"), zero("ticks"))
    return out.withColumn("events", F.col("heads") + F.col("ticks"))


def rule_census(counts: DataFrame, truth: DataFrame, rules: Mapping[str, Callable[[DataFrame], DataFrame]], baseline: str, by: Sequence[str]) -> DataFrame:
    """rule, n, exact, breaks, fixes, within_5: each rule's counts(by, n) against truth(by, expected), and against the baseline rule."""
    graded = None
    for name, rule in rules.items():
        got = rule(counts).join(truth, list(by)).select(*by, F.lit(name).alias("rule"), (F.col("n") == F.col("expected")).alias("ok"), (F.abs(F.col("n") - F.col("expected")) <= 5).alias("near"))
        graded = got if graded is None else graded.unionByName(got)
    base = F.max(F.when(F.col("rule") == baseline, F.col("ok"))).over(Window.partitionBy(*by))
    rows = graded.withColumn("base", base)
    return rows.groupBy("rule").agg(
        F.count("*").alias("n"), F.count_if("ok").alias("exact"), F.count_if(F.col("base") & ~F.col("ok")).alias("breaks"),
        F.count_if(~F.col("base") & F.col("ok")).alias("fixes"), F.count_if("near").alias("within_5"),
    )
