"""Which notes hold a rail, which are only the caps of holds, and notes timed at the wrong speed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._range import asof, overlap_join


def rail_lag(notes: DataFrame, by: Sequence[str], gap: float, default: float = 0.06) -> DataFrame:
    """by, lag: how early a rail's ends are read: `gap` over the median speed of notes(by, v), v being negative upward; `default` without speeds."""
    rows = notes.groupBy(*by).agg(F.percentile(F.when(F.col("v") != 0, -F.col("v")), F.lit(0.5)).alias("_m"))
    return rows.select(*by, F.when(F.col("_m").isNotNull() & (F.col("_m") != 0), gap / F.col("_m")).otherwise(default).alias("lag"))


def claim_holds(notes: DataFrame, rails: DataFrame, lane: DataFrame, lags: DataFrame, by: Sequence[str], width: float, most: float = 0.15, least: float = 0.05, share: float = 0.6, inside: tuple[float, float] = (0.02, 0.08)) -> DataFrame:
    """notes(by, col, id, t) with hold_end, rail_len and rail_occ; notes inside a claimed rail that didn't open it go.

    A rail(by, col, rail, a, b) is claimed by the note of its column nearest to its start (ties: the first), within
    min(most, max(least, share * length)), once its lag(by, lag) is taken out; a note that claims several has the last one's end.
    rail_occ is the mean of lane(by, col, t, occ) over [a, b), of the first frame from a on if there is none. A note more than inside[0] after
    a claimed rail's start and less than inside[1] after its end is its cap; only rails that a note opened are trusted so.
    """
    key = [*by, "col"]
    shifted = rails.join(lags, list(by)).withColumn("s", F.col("a") + F.col("lag")).withColumn("e", F.col("b") + F.col("lag"))
    window = F.least(F.lit(most), F.greatest(F.lit(least), share * (F.col("b") - F.col("a"))))
    reach = shifted.select(*key, "rail", "a", "b", "s", "e", window.alias("_w")).withColumn("_lo", F.col("s") - F.col("_w")).withColumn("_hi", F.col("s") + F.col("_w"))
    points = notes.select(*key, F.col("id").alias("_id"), F.col("t").alias("_t"), F.col("t").alias("_u"))
    near = overlap_join(reach, points, key, ("_lo", "_hi"), ("_t", "_u"), width, closed=True).filter(F.abs(F.col("s") - F.col("_t")) <= F.col("_w"))
    claims = near.groupBy(*key, "rail", "a", "b", "s", "e").agg(F.min(F.struct(F.abs(F.col("s") - F.col("_t")).alias("d"), "_t", "_id"))["_id"].alias("id")).checkpoint()  # read for ends, lanes and caps
    frames = lane.select(*key, F.col("t").alias("_t"), F.col("t").alias("_u"), "occ")
    seen = overlap_join(claims.select(*key, "rail", "a", "b"), frames, key, ("a", "b"), ("_t", "_u"), width, closed=True).filter("_t >= a AND _t < b").groupBy(*key, "rail").agg(F.avg("occ").alias("_mean"))
    bare = claims.join(seen, [*key, "rail"], "left_anti").select(*key, "rail", F.col("a").alias("_at"))
    first = asof(bare, lane.select(*key, F.col("t").alias("_at"), "occ"), key, "_at", ["occ"], "forward").select(*key, "rail", F.col("occ").alias("_mean"))
    held = claims.join(seen.unionByName(first), [*key, "rail"], "left")
    last = held.groupBy(*key, "id").agg(F.max(F.struct("rail", F.col("e").alias("hold_end"), (F.col("b") - F.col("a")).alias("rail_len"), F.coalesce("_mean", F.lit(0.0)).alias("rail_occ"))).alias("_h"))
    last = last.select(*key, "id", "_h.hold_end", "_h.rail_len", "_h.rail_occ")
    spans = claims.select(*key, F.col("id").alias("_owner"), (F.col("s") + inside[0]).alias("_s"), (F.col("e") + inside[1]).alias("_e"))
    caps = overlap_join(spans, points, key, ("_s", "_e"), ("_t", "_u"), width).filter("_id <> _owner AND _t > _s AND _t < _e").select(*key, F.col("_id").alias("id")).distinct()
    return notes.join(caps, [*key, "id"], "left_anti").join(last, [*key, "id"], "left")


def drop_short_caps(notes: DataFrame, bars: DataFrame, lags: DataFrame, by: Sequence[str], width: float, gap: tuple[float, float], head: tuple[float, float], cap: float, speed: float, opens: float, bar: tuple[float, float], closes: float) -> DataFrame:
    """notes(by, col, id, t, v, q, hold_end) without the tail caps of short holds that no rail was claimed for.

    Of two notes that follow each other in a column, the second is a cap if the first holds no rail and is no cap itself, they are gap apart,
    their correlations q are within head and under cap times the series' median (a null q is unknown), their speeds differ by at most `speed`, and a loose
    bar(by, col, a, b) of a length within `bar` opens within `opens` of the first and closes within `closes` of the second, its lag taken out.
    """
    key = [*by, "col"]
    middle = notes.groupBy(*by).agg(F.percentile("q", F.lit(0.5)).alias("_m"))
    order = Window.partitionBy(*key).orderBy("t", "id")
    before = lambda c: F.lag(c).over(order)
    rows = notes.join(middle, list(by), "left").withColumn("_n", F.row_number().over(order)).withColumn("_t0", before("t"))
    apart = F.col("t") - F.col("_t0")
    q0, q1 = before("q"), F.col("q")
    fits = before("hold_end").isNull() & (apart >= gap[0]) & (apart <= gap[1]) & (q0 >= head[0] * F.col("_m")) & (q0 < head[1] * F.col("_m")) & (q1 < cap * F.col("_m")) & (before("v") != 0) & (F.abs(F.col("v") / F.nullif(before("v"), F.lit(0.0)) - 1) <= speed)
    rows = rows.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    some = rows.filter("_fits").select(*key, "id", "t", "_t0", (F.col("_t0") - opens).alias("_lo"), (F.col("_t0") + opens).alias("_hi"))
    loose = bars.join(lags, list(by)).filter((F.col("b") - F.col("a") >= bar[0]) & (F.col("b") - F.col("a") <= bar[1])).select(*key, (F.col("a") + F.col("lag")).alias("_s"), (F.col("a") + F.col("lag")).alias("_s1"), (F.col("b") + F.col("lag")).alias("_e"))
    hit = overlap_join(some, loose, key, ("_lo", "_hi"), ("_s", "_s1"), width, closed=True).filter((F.abs(F.col("_s") - F.col("_t0")) <= opens) & (F.abs(F.col("_e") - F.col("t")) <= closes)).select(*key, "id", F.lit(True).alias("_bar")).distinct()
    rows = rows.join(hit, [*key, "id"], "left").withColumn("_cap", F.coalesce("_bar", F.lit(False)))
    place = Window.partitionBy(*key).orderBy("_n")
    rows = rows.withColumn("_last", F.max(F.when(~F.col("_cap"), F.col("_n"))).over(place))  # the first note of a column is none
    return rows.filter((F.col("_n") - F.col("_last")) % 2 == 0).select(*notes.columns)  # after a cap the next one opens anew


def retime(notes: DataFrame, by: Sequence[str], off: float, most_frames: int, around: int = 25) -> DataFrame:
    """notes(by, t, v, frames, mt, my, yj) with t moved, and retimed: where a note of at most `most_frames` frames is more than `off` faster or slower than the median of the notes around it, it crosses yj from its centroid (mt, my) at that median."""
    order = Window.partitionBy(*by).orderBy("t", "id").rowsBetween(-around, around - 1)
    rows = notes.withColumn("_m", F.percentile(-F.col("v"), F.lit(0.5)).over(order))
    odd = F.coalesce((F.col("_m") > 0) & F.col("mt").isNotNull() & (F.col("frames") <= most_frames) & (F.abs(-F.col("v") / F.when(F.col("_m") != 0, F.col("_m")) - 1) > off), F.lit(False))
    moved = F.col("mt") - (F.col("yj") - F.col("my")) / F.when(F.col("_m") != 0, F.col("_m"))
    return rows.withColumn("retimed", odd).withColumn("t", F.when(odd, moved).otherwise(F.col("t"))).drop("_m")
