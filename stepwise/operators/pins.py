"""What a count pins down: holds that it tells from taps, tails that it places, tiles that measured spans replace; and series to watch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._range import asof, overlap_join
from .intervals import interpolate, overlap_filter
from .series import spread
from .signals import less_percentile


def _steps(steps: DataFrame, by: Sequence[str], unit: int) -> DataFrame:
    """Steps with the last lattice point before each, and the first one past it, as beats in units; null where there is none."""
    order = Window.partitionBy(*by).orderBy("b0")
    point = lambda k: k * unit / F.col("value")
    rate = F.col("value") > 0
    end = F.coalesce(F.col("b1").cast("double"), F.lit(1e15))
    last = F.when(rate & F.col("b1").isNotNull(), point(F.ceil(F.col("b1") * F.col("value") / unit) - 1))
    first = F.when(rate, point(F.ceil(F.col("b0") * F.col("value") / unit)))
    rows = steps.withColumn("_last", F.when(last >= F.col("b0"), last)).withColumn("_first", F.when(first < end, first))
    rows = rows.withColumn("before", F.last("_last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("after", F.first("_first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)))
    return rows.select(*by, "b0", "b1", "value", "before", "after", "_first")


def own_points(holds: DataFrame, steps: DataFrame, rows: DataFrame, by: Sequence[str], unit: int) -> DataFrame:
    """by, hold, own: the lattice points in (head, tail] that no other hold covers and no row stands on; holds without any are left out.

    A sweep over the ends of holds and the changes of rate: between two of them, how many holds are
    open and the sum of their names are running sums, so where one is open its name is known.
    """
    name = F.col("hold").cast("decimal(38,0)")
    none = F.lit(None).cast("long")
    ends = holds.select(*by, F.explode(F.array(F.struct(F.col("head").alias("x"), F.lit(1).alias("d"), name.alias("n")), F.struct(F.col("tail").alias("x"), F.lit(-1).alias("d"), (-name).alias("n")))).alias("e")).select(*by, "e.*", none.alias("rate"))
    every = ends.unionByName(steps.select(*by, F.col("b0").alias("x"), F.lit(0).alias("d"), F.lit(0).cast("decimal(38,0)").alias("n"), F.col("value").cast("long").alias("rate")))
    order = Window.partitionBy(*by).orderBy("x")
    cut = every.groupBy(*by, "x").agg(F.sum("d").alias("d"), F.sum("n").alias("n"), F.max("rate").alias("rate"))
    cut = cut.withColumn("open", F.sum("d").over(order)).withColumn("hold", F.sum("n").over(order).cast("long")).withColumn("rate", F.coalesce(F.last("rate", ignorenulls=True).over(order), F.lit(0)))
    cut = cut.withColumn("to", F.lead("x").over(order)).withColumn("at_end", F.lead("rate").over(order))
    inside = F.when(F.col("rate") > 0, F.ceil(F.col("to") * F.col("rate") / unit) - 1 - F.floor(F.col("x") * F.col("rate") / unit)).otherwise(0)
    last = F.when((F.col("at_end") > 0) & (F.col("to") * F.col("at_end") % unit == 0), 1).otherwise(0)  # it counts at the rate that starts there
    alone = cut.filter("open = 1 AND to IS NOT NULL")
    points = alone.select(*by, "hold", (inside + last).alias("n"))
    at = asof(rows.select(*by, "beat").distinct().withColumn("_x", F.col("beat")), cut.select(*by, F.col("x").alias("_x"), "open", "hold"), by, "_x", ["open", "hold"], strict=True)
    at = asof(at, steps.select(*by, F.col("b0").alias("_x"), F.col("value").alias("_rate")), by, "_x", ["_rate"])
    taken = at.filter((F.col("open") == 1) & (F.col("_rate") > 0) & (F.col("beat") * F.col("_rate") % unit == 0)).select(*by, "hold", F.lit(-1).alias("n"))
    return points.unionByName(taken).groupBy(*by, "hold").agg(F.sum("n").cast("long").alias("own")).filter("own > 0")


def pinned_holds(holds: DataFrame, steps: DataFrame, rows: DataFrame, tempo: DataFrame, by: Sequence[str], unit: int, tolerance: float = 0.06, ahead: int = 8) -> DataFrame:
    """by, hold, own, early, late, state_pinned, tail_pinned: whether the count says that a hold is one, and where it ends.

    holds(by, hold, head, tail), steps(by, b0, b1, value) and rows(by, beat) in 1/unit beats; tempo(by, t, y) gives the time y of a
    beat t (in the same units). A hold is pinned if it has a point of its own. early and late: how far its tail can slide before it
    crosses a point (to its head at most; 9 where none follows within `ahead` beats); it is pinned if both are under the tolerance.
    """
    own = own_points(holds, steps, rows, by, unit)
    known = _steps(steps, by, unit)
    around = asof(holds.withColumn("_x", F.col("tail")), known.withColumn("_x", F.col("b0")), by, "_x", ["b0", "b1", "value", "before", "after"]).drop("_x")
    around = around.join(known.groupBy(*by).agg(F.min("_first").alias("_any")), list(by), "left").withColumn("after", F.when(F.col("b0").isNull(), F.col("_any")).otherwise(F.col("after")))  # a tail before all steps
    rate = F.col("value") > 0
    here = lambda k: F.when(rate, k * unit / F.col("value"))
    back = here(F.floor(F.col("tail") * F.col("value") / unit))
    back = F.when(back >= F.col("b0"), back).otherwise(F.col("before"))
    back = F.when(back > F.col("head"), back).otherwise(F.col("head").cast("double"))
    on = here(F.floor(F.col("tail") * F.col("value") / unit) + 1)
    on = F.when(on < F.coalesce(F.col("b1").cast("double"), F.lit(1e15)), on).otherwise(F.col("after"))
    on = F.when(on <= F.col("tail") + ahead * unit, on)
    out = around.withColumn("_back", back).withColumn("_on", on)
    for c in ("tail", "_back", "_on"):
        out = interpolate(tempo, out.withColumn("t", F.col(c).cast("double")), by, outside="extend").withColumn(f"_t_{c}", F.col("y")).drop("t", "y")
    out = out.withColumn("early", F.col("_t_tail") - F.col("_t__back")).withColumn("late", F.when(F.col("_on").isNull(), 9.0).otherwise(F.col("_t__on") - F.col("_t_tail")))
    out = out.join(own, [*by, "hold"], "left").withColumn("own", F.coalesce("own", F.lit(0)))
    pinned = F.col("own") > 0
    return out.select(*by, "hold", "own", "early", "late", pinned.alias("state_pinned"), (pinned & (F.col("early") < tolerance) & (F.col("late") < tolerance)).alias("tail_pinned"))


def watched(notes: DataFrame, holds: DataFrame, pinned: DataFrame, by: str, n: int = 15, jack: float = 0.25, short: float = 0.25) -> DataFrame:
    """kind, by, n: for each kind, the n series with most jacks (a note less than `jack` before the next of its column), short holds (shorter than `short`), and pinned tails; ties by name.

    notes(by, col, t), holds(by, hold, head, tail) in time, pinned as pinned_holds gives it. Series without any aren't listed.
    """
    order = Window.partitionBy(by, "col").orderBy("t")
    jacks = notes.withColumn("_j", F.lead("t").over(order) - F.col("t") < jack).filter("_j").select(by, F.lit("jack").alias("kind"))
    shorts = holds.filter(F.col("tail") - F.col("head") < short).select(by, F.lit("short_hold").alias("kind"))
    pins = pinned.filter("tail_pinned").select(by, F.lit("pinned_tail").alias("kind"))
    counted = jacks.union(shorts).union(pins).groupBy("kind", by).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), by))
    return counted.withColumn("_k", rank).filter(F.col("_k") <= n).select("kind", by, "n")  # a top-n report


def replace_tiles(tiles: DataFrame, pins: DataFrame, by: Sequence[str], width: float, touch: float = 1e-6, sliver: float = 0.05) -> DataFrame:
    """by, t0, t1, pinned: tiles(by, t0, t1), and pins(by, t0, t1, value, rank) in place of all that they overlap.

    A pin also replaces pins of lower rank that it overlaps. Ends that touch don't overlap. Tiles shorter than `sliver` go.
    """
    spans = pins.select(*by, F.col("t0").alias("ps"), F.col("t1").alias("pe"))
    left = overlap_filter(tiles.select(*by, F.col("t0").alias("s"), F.col("t1").alias("e")), spans, by, width, -touch)
    left = left.filter(F.col("e") - F.col("s") >= sliver).select(*by, F.col("s").alias("t0"), F.col("e").alias("t1"), F.lit(None).cast(pins.schema["value"].dataType).alias("pinned"))
    a = pins.select(*by, F.col("rank").alias("_r"), (F.col("t0") + touch).alias("_a"), (F.col("t1") - touch).alias("_b"))
    b = pins.select(*by, F.col("rank").alias("_q"), F.col("t0").alias("_c"), F.col("t1").alias("_d"))
    beaten = overlap_join(a, b, by, ("_a", "_b"), ("_c", "_d"), width).filter("_q > _r").select(*by, F.col("_r").alias("rank")).distinct()
    return left.unionByName(pins.join(beaten, [*by, "rank"], "left_anti").select(*by, "t0", "t1", F.col("value").alias("pinned")))


def local_heights(signal: DataFrame, by: Sequence[str], value: str = "v", least: float = 5.0, back: int = 30, q: float = 0.3) -> DataFrame:
    """by, n, low, middle, high: how many local maxima a signal's rise has (over the q-th percentile of its last frames), and their 10th, 50th and 90th percentile.

    A maximum is not under the frame before it, above the one after it, and over `least`; the first and the last frame are none.
    """
    order = Window.partitionBy(*by).orderBy("frame")
    rise = F.col("_rise")
    rows = less_percentile(signal, value, q, order.rowsBetween(-back, 0), "_rise")
    rows = rows.withColumn("_top", (rise >= F.lag("_rise").over(order)) & (rise > F.lead("_rise").over(order)) & (rise > least)).filter("_top")
    at = lambda p: F.percentile("_rise", F.lit(p))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), at(0.1).alias("low"), at(0.5).alias("middle"), at(0.9).alias("high"))


#: How much a row on each twelfth of a beat speaks for that twelfth being the beat (fixed values).
WEIGHT = {0: 4, 2: 1, 3: 2, 4: 2, 6: 3, 8: 2, 9: 2, 10: 1}


def tempo_and_origin(rows: DataFrame, by: Sequence[str], coarse: DataFrame, span: float = 0.02, step: float = 0.0005) -> DataFrame:
    """by, bpm, strength, origin: a fine search round the tempo that tempo_scan() found, and a time at which a beat falls.

    rows(by, t in seconds), coarse(by, bpm). The fine tempo is the first best of bpm - span, + step, ... The mean angle of t on the
    lattice of twelfths gives its phase; the twelfth whose rows weigh most as beats (WEIGHT, ties: the first) is the origin.
    """
    tau = F.lit(6.283185307179586)
    notes = spread(rows.select(*by, "t"), by)
    tries = notes.join(coarse.select(*by, F.col("bpm").alias("_c")), list(by)).select(*by, "t", "_c", F.explode(F.sequence(F.lit(0), F.lit(round(2 * span / step) - 1))).alias("_k")).withColumn("bpm", F.col("_c") - span + F.col("_k") * step)
    phase = tau * F.col("t") * F.col("bpm") * 12 / 60
    strength = lambda p: F.sqrt(F.pow(F.avg(F.cos(p)), 2) + F.pow(F.avg(F.sin(p)), 2))
    fine = tries.groupBy(*by, "bpm").agg(strength(phase).alias("strength"))
    best = fine.groupBy(*by).agg(F.max_by(F.struct("bpm", "strength"), F.struct(F.round("strength", 9), -F.col("bpm"))).alias("_b")).select(*by, "_b.bpm", "_b.strength").checkpoint()  # a row for each key, read twice
    width = 60 / F.col("bpm") / 12
    start = notes.join(best, list(by)).groupBy(*by).agg((F.atan2(F.avg(F.sin(tau * F.col("t") / width)), F.avg(F.cos(tau * F.col("t") / width))) / tau * F.first(width)).alias("_t0"))
    start = best.join(start, list(by)).checkpoint()
    places = notes.join(start, list(by)).withColumn("_p", F.rint((F.col("t") - F.col("_t0")) / width).cast("long"))
    votes = places.groupBy(*by, F.pmod("_p", F.lit(12)).cast("int").alias("_r")).agg(F.count("*").alias("_n"))
    weigh = lambda k: F.try_element_at(F.create_map(*(x for r, w in WEIGHT.items() for x in (F.lit(r), F.lit(w)))), F.pmod(F.col("_r") - k, F.lit(12)))
    each = votes.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(11)))).groupBy(*by, "k").agg(F.sum(F.col("_n") * F.coalesce(weigh(F.col("k")), F.lit(0))).alias("_w"))
    first = each.groupBy(*by).agg(F.max_by("k", F.struct("_w", -F.col("k"))).alias("k"))
    return start.join(first, list(by)).select(*by, "bpm", "strength", (F.col("_t0") + F.col("k") * width).alias("origin"))
