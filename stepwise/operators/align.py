"""Alignment of observed and declared series: offset, clock and tempo."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._range import asof, count_at, nearest, overlap_join
from .intervals import count_between, overlap_filter
from .series import spread


def offset_sweep(obs: DataFrame, ref: DataFrame, by: Sequence[str], col: str, lo: int, hi: int, step: int, tol: int) -> DataFrame:
    """by, offset, hits, error: the offset (lo, lo + step, ... to hi) that maximises (hits, -median error); ties: the smallest.

    obs(by, col, t) moved by the offset hit the first ref(by, col, t) at or after t - tol if
    it is within tol. Only pairs that some offset can bring together are formed (a range
    join inside the search span); each pair is counted at the offsets it fits.
    """
    o = obs.select(*by, col, F.col("t").alias("_t"), (F.col("t") + lo - tol).alias("_a"), (F.col("t") + hi + tol).alias("_b"))
    o = o.withColumn("_id", F.xxhash64(*by, col, "_t"))
    r = ref.select(*by, col, F.col("t").alias("_r"), F.col("t").alias("_r2"))
    pairs = overlap_join(o, r, [*by, col], ("_a", "_b"), ("_r", "_r2"), max(hi - lo + 2 * tol, 1), closed=True)
    d = F.col("_r") - F.col("_t")
    first, last = F.greatest(F.lit(0), F.ceil((d - tol - lo) / step)), F.least(F.lit((hi - lo) // step), F.floor((d + tol - lo) / step))
    fits = pairs.withColumn("_i", F.when(first <= last, F.sequence(first.cast("long"), last.cast("long")))).withColumn("_i", F.explode("_i"))
    fits = fits.withColumn("offset", F.col("_i") * step + lo)
    hits = fits.groupBy(*by, col, "_id", "offset").agg(F.min("_r").alias("_r"), F.first("_t").alias("_t"))
    scores = hits.groupBy(*by, "offset").agg(F.count("*").alias("hits"), F.percentile(F.abs(F.col("_r") - F.col("_t") - F.col("offset")), F.lit(0.5)).alias("error"))
    return scores.groupBy(*by).agg(F.max_by(F.struct("offset", "hits", "error"), F.struct("hits", -F.col("error"), -F.col("offset"))).alias("_b")).select(*by, "_b.offset", "_b.hits", "_b.error")


def refine(coarse: DataFrame, obs: DataFrame, ref: DataFrame, by: Sequence[str], col: str, span: int, step: int, tol: int) -> DataFrame:
    """The sweep again in steps of `step` within `span` of each series' coarse offset."""
    moved = obs.join(coarse.select(*by, F.col("offset").alias("_o")), list(by)).withColumn("t", F.col("t") + F.col("_o"))
    fine = offset_sweep(moved.drop("_o"), ref, by, col, -span, span, step, tol)
    return fine.join(coarse.select(*by, F.col("offset").alias("_o")), list(by)).select(*by, (F.col("offset") + F.col("_o")).alias("offset"), "hits", "error")


def fit_violation(anchors: DataFrame, taps: DataFrame, offsets: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, offset, score: the offset with the least violation: the slack (cum - taps so far) under zero, plus its falls below its running maximum, which starts at -1.

    anchors(by, t, cum), taps(by, t), offsets(offset): a small candidate table.
    """
    grid = anchors.crossJoin(F.broadcast(offsets)).withColumn("_at", F.col("t") - F.col("offset"))  # offsets: a table of fixed size
    rows = count_at(taps, grid, by, "t", "_at", "_n").withColumn("slack", F.col("cum") - F.col("_n"))
    order = Window.partitionBy(*by, "offset").orderBy("t", "cum")
    top = F.max("slack").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_bad", F.greatest(-F.col("slack"), F.lit(0)) + F.greatest(F.greatest(F.coalesce(top, F.lit(-1)), F.lit(-1)) - F.col("slack"), F.lit(0)))
    scores = rows.groupBy(*by, "offset").agg(F.sum("_bad").alias("score"))
    return scores.groupBy(*by).agg(F.min_by(F.struct("offset", "score"), F.struct("score", "offset")).alias("_b")).select(*by, "_b.offset", "_b.score")


def fit_two_sided(anchors: DataFrame, taps: DataFrame, holds: DataFrame, offsets: DataFrame, by: Sequence[str], width: float, near: float = 0.3, far: float = 6.0, pad: float = 0.15, least: int = 8) -> DataFrame:
    """by, offset, error, n: the offset with the least mean |rise of cum - taps| over neighbouring anchors near to far apart, of a counter that doesn't fall, that no hold(by, ps, pe) touches and that don't start before 0, given `least` of them."""
    order = Window.partitionBy(*by).orderBy("t", "cum")
    pairs = anchors.select(*by, F.col("t").alias("s"), F.lead("t").over(order).alias("e"), (F.lead("cum").over(order) - F.col("cum")).alias("_d")).filter((F.col("e") - F.col("s") >= near) & (F.col("e") - F.col("s") <= far) & (F.col("_d") >= 0))
    grid = pairs.crossJoin(F.broadcast(offsets)).withColumn("s", F.col("s") - F.col("offset")).withColumn("e", F.col("e") - F.col("offset"))  # offsets: a table of fixed size
    free = overlap_filter(grid.filter("s >= 0"), holds, by, width, pad)
    rows = count_between(taps, free.withColumn("lo", F.col("s")).withColumn("hi", F.col("e")), by, out="_n")
    scores = rows.groupBy(*by, "offset").agg(F.avg(F.abs(F.col("_d") - F.col("_n"))).alias("error"), F.count("*").alias("n")).filter(F.col("n") >= least)
    return scores.groupBy(*by).agg(F.min_by(F.struct("offset", "error", "n"), F.struct(F.round("error", 9), "offset")).alias("_b")).select(*by, "_b.offset", "_b.error", "_b.n")


def fit_zero(reads: DataFrame, taps: DataFrame, offsets: DataFrame, by: Sequence[str], lag: float = 0.15) -> DataFrame:
    """by, offset, zeros: the offset at which most reads equal the taps so far (at t - offset - lag); ties: the smallest."""
    grid = reads.crossJoin(F.broadcast(offsets)).withColumn("_at", (F.col("t") - F.col("offset") - lag).cast(taps.schema["t"].dataType))  # offsets: a table of fixed size
    rows = count_at(taps, grid, by, "t", "_at", "_n")
    scores = rows.groupBy(*by, "offset").agg(F.count_if(F.col("_n") == F.col("v")).alias("zeros"))
    return scores.groupBy(*by).agg(F.max_by(F.struct("offset", "zeros"), F.struct("zeros", -F.col("offset"))).alias("_b")).select(*by, "_b.offset", "_b.zeros")


def fit_lattice(notes: DataFrame, tempo: DataFrame, by: Sequence[str], grids: Sequence[int] = (4, 8, 12, 16, 24, 32), low: float = 0.0, high: float = 60.0, step: float = 0.002, fine: float = 0.001, rates: Sequence[float] = tuple(k / 10_000 for k in range(-25, 26))) -> DataFrame:
    """by, grid, offset, rate, score: the coarsest lattice (lines a beat) whose score is within 0.005 of the best, and where the notes lie on it.

    notes(by, t) are heard at offset + t / (1 + rate) of the tempo map(by, t, beat), which is interpolated. The score is the share of notes inside
    the map's times, times 1 less the 75th percentile of their distance to the nearest line, in half spacings; -1 where less
    than half are inside. For each grid, offsets from low to under high by `step`, then twice in turn all rates, and 25 steps of `fine` either
    side; the first best counts. Series without notes or without a map are left out.
    """
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in notes.select(*by).schema.fields)

    def fit(key: tuple, d: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        if d.empty or m.empty:
            return pd.DataFrame(columns=[*by, "grid", "offset", "rate", "score"])
        m = m.sort_values("t")
        t, times, beats = d["t"].to_numpy(float), m["t"].to_numpy(float), m["beat"].to_numpy(float)

        def scores(offsets: np.ndarray, clocks: np.ndarray, grid: int) -> np.ndarray:
            """One score for each offset and clock rate (arrays of one length)."""
            at = (t[None, :] - offsets[:, None]) * (1 + clocks[:, None])
            inside = (at >= times[0]) & (at <= times[-1])
            y = np.interp(at, times, beats) * grid
            e = np.sort(np.where(inside, 2 * np.abs(y - np.round(y)), np.inf), axis=1)
            n = inside.sum(1)
            place = 0.75 * np.maximum(n - 1, 0)
            i = np.floor(place).astype(int)
            j = np.minimum(i + 1, np.maximum(n - 1, 0))
            rows = np.arange(len(n))
            a, b = e[rows, i], e[rows, j]
            share = n / len(t)
            with np.errstate(invalid="ignore"):
                return np.where(share < 0.5, -1.0, share * (1 - (a + (b - a) * (place - i))))

        def best_of(best: tuple, offsets: np.ndarray, clocks: np.ndarray, grid: int) -> tuple:
            for k in range(0, len(offsets), 512):  # so many at once
                got = scores(offsets[k : k + 512], clocks[k : k + 512], grid)
                i = int(np.argmax(got))
                if got[i] > best[0]:
                    best = (float(got[i]), float(offsets[k + i]), float(clocks[k + i]))
            return best

        found = []
        start = np.arange(int(low / step), int(high / step)) * step
        for grid in sorted(grids):
            best = best_of((-1.0, 0.0, 0.0), start, np.zeros(len(start)), grid)
            for _ in range(2):
                best = best_of(best, np.full(len(rates), best[1]), np.array(rates), grid)
                near = best[1] + np.arange(-25, 26) * fine
                best = best_of(best, near, np.full(len(near), best[2]), grid)
            found.append((grid, *best))
        top = max(f[1] for f in found)
        grid, score, offset, rate = next(f for f in found if f[1] >= top - 0.005)
        return pd.DataFrame([[*key, grid, offset, rate, score]], columns=[*by, "grid", "offset", "rate", "score"])

    own = tempo.select(*(F.col(c).alias(c) for c in [*by, "t", "beat"]))
    return spread(notes.select(*by, "t"), by).groupBy(*by).cogroup(spread(own, by).groupBy(*by)).applyInPandas(fit, f"{keys}, grid long, offset double, rate double, score double")


def fit_clock(obs: DataFrame, ref: DataFrame, by: Sequence[str], tol: float = 0.06, rounds: int = 3, least: int = 20, span: float = 0.01) -> DataFrame:
    """by, slope, intercept, n: obs time as a line of ref time, in rounds of matching within tol and least squares; the slope is held to 1 +- span; a series under `least` pairs keeps its last line."""
    lines = obs.select(*by).distinct().select(*by, F.lit(1.0).alias("slope"), F.lit(0.0).alias("intercept"), F.lit(0).cast("long").alias("n"))
    points = ref.select(*by, F.col("t").cast("double").alias("_ref"))
    for _ in range(rounds):
        moved = points.join(lines, list(by)).withColumn("t", F.col("_ref") * F.col("slope") + F.col("intercept"))
        pairs = nearest(moved.select(*by, "_ref", "t"), obs.select(*by, F.col("t").cast("double").alias("t")), by, "t", "_obs", tol).filter("_obs IS NOT NULL")
        middle = pairs.groupBy(*by).agg(F.avg("_ref").alias("_mx"), F.avg("_obs").alias("_my"), F.regr_slope("_obs", "_ref").alias("_k"), F.count("*").alias("_n"))
        k = F.greatest(F.lit(1 - span), F.least(F.lit(1 + span), F.coalesce("_k", F.lit(1.0))))
        good = F.coalesce(F.col("_n") >= least, F.lit(False))
        joined = lines.join(middle, list(by), "left").withColumn("_s", k)
        lines = joined.select(*by, F.when(good, F.col("_s")).otherwise(F.col("slope")).alias("slope"), F.when(good, F.col("_my") - F.col("_s") * F.col("_mx")).otherwise(F.col("intercept")).alias("intercept"), F.when(good, F.col("_n")).otherwise(F.col("n")).alias("n"))
    return lines


def tempo_scan(rows: DataFrame, by: Sequence[str], tempi: DataFrame, apart: float = 0.5) -> DataFrame:
    """by, bpm, strength, elsewhere: the tempo with the longest mean vector of exp(2 pi i t bpm 12 / 60), and the best one more than `apart` from it.

    rows(by, t in seconds), tempi(bpm): a candidate table of fixed size.
    """
    phase = F.lit(2 * np.pi) * F.col("t") * F.col("bpm") * 12 / 60
    grid = spread(rows.select(*by, "t"), by).crossJoin(F.broadcast(tempi)).groupBy(*by, "bpm").agg(F.sqrt(F.pow(F.avg(F.cos(phase)), 2) + F.pow(F.avg(F.sin(phase)), 2)).alias("strength"))
    tried = grid.groupBy(*by).agg(F.collect_list(F.struct(F.round("strength", 9).alias("s"), (-F.col("bpm")).alias("low"), "bpm", "strength")).alias("_g"))  # one for each candidate
    best = tried.withColumn("_b", F.array_max("_g"))
    other = F.array_max(F.filter("_g", lambda x: F.abs(x["bpm"] - F.col("_b.bpm")) > apart))["bpm"]
    known = reduce(and_, (F.col(c).isNotNull() for c in by))
    return best.select(*by, "_b.bpm", "_b.strength", F.when(known, other).alias("elsewhere"))


def rolling_drift(notes: DataFrame, by: Sequence[str], half: int, grid: float) -> DataFrame:
    """notes(by, t whole, ...) with residual to the nearest line of `grid`, drift (its median within +-half) and left (their difference)."""
    order = Window.partitionBy(*by).orderBy("t").rangeBetween(-half, half)
    rows = notes.withColumn("residual", F.col("t") - F.round(F.col("t") / grid) * grid)
    rows = rows.withColumn("drift", F.percentile("residual", F.lit(0.5)).over(order))
    return rows.withColumn("left", F.col("residual") - F.col("drift"))


def worst_drift(drifted: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, worst: the largest correction of rolling_drift."""
    return drifted.groupBy(*by).agg(F.max(F.abs("drift")).alias("worst"))


def retime(notes: DataFrame, by: Sequence[str], speed: str = "speed", reach: float = 1.0, rows_around: int = 25) -> DataFrame:
    """notes(by, t, speed) re-timed by the median speed of the 25 before and 24 after: t + reach / speed - reach / median."""
    order = Window.partitionBy(*by).orderBy("t").rowsBetween(-rows_around, rows_around - 1)
    middle = F.percentile(speed, F.lit(0.5)).over(order)
    return notes.withColumn("_m", middle).withColumn("retimed", F.col("t") + reach / F.col(speed) - reach / F.col("_m")).drop("_m")


def accrual_map(anchors: DataFrame, taps: DataFrame, holds: DataFrame, by: Sequence[str], width: float) -> DataFrame:
    """by, s, e, gain, rate, held: where cum - taps rises above its running maximum between two anchors, and whether the file has a hold(by, ps, pe) there."""
    order = Window.partitionBy(*by).orderBy("t", "cum")
    rows = count_at(taps, anchors, by, "t", "t", "_n").withColumn("slack", F.col("cum") - F.col("_n"))
    top = F.max("slack").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("s", F.lag("t").over(order)).withColumn("_top", top).filter("slack > _top").withColumn("gain", F.col("slack") - F.col("_top")).withColumn("e", F.col("t"))
    held = overlap_filter(rows.select(*by, "s", "e", "gain"), holds, by, width, keep="count")
    return held.select(*by, "s", "e", "gain", (F.col("gain") / (F.col("e") - F.col("s"))).alias("rate"), (F.col("n_spans") > 0).alias("held"))


def place(points: DataFrame, queries: DataFrame, by: Sequence[str]) -> DataFrame:
    """queries(by, t) with the offset of the last fitted point(by, t, offset) at or before it."""
    return asof(queries, points, by, "t", ["offset"])


def floor_agreement(notes: DataFrame, flashes: DataFrame, floors: DataFrame, by: Sequence[str], lead: float, span: float = 0.25, step: float = 0.01, tol: float = 0.07) -> DataFrame:
    """by, floor, offset, matched, n_obs, n_ref: for each floor, the offset at which most flashes have a note of their column within tol (ties: the smallest), for best_floor().

    notes(by, col, t, q), those of at least the floor's q count; flashes(by, col, t); floors(by, floor). Offsets go from lead - span by step up to
    under lead + span. A series without flashes, and a floor that leaves no notes, are left out.
    """
    offsets = F.transform(F.sequence(F.lit(0), F.lit(round(2 * span / step) - 1)), lambda k: F.lit(lead - span) + k * step)
    kept = notes.join(floors, list(by)).filter("q >= floor")
    size = kept.groupBy(*by, "floor").agg(F.count("*").alias("n_obs")).join(flashes.groupBy(*by).agg(F.count("*").alias("n_ref")), list(by))
    wanted = flashes.join(floors, list(by)).withColumn("offset", F.explode(offsets)).withColumn("_from", F.col("t") - tol - F.col("offset"))
    own = kept.select(*by, "col", "floor", F.col("t").alias("_from"), F.col("t").alias("_got"))
    found = asof(wanted, own, [*by, "col", "floor"], "_from", ["_got"], "forward")
    hit = F.coalesce(F.abs(F.col("_got") + F.col("offset") - F.col("t")) <= tol, F.lit(False))
    counted = found.groupBy(*by, "floor", "offset").agg(F.count_if(hit).alias("matched"))
    best = counted.groupBy(*by, "floor").agg(F.max_by(F.struct("offset", "matched"), F.struct("matched", -F.col("offset"))).alias("_b"))
    return best.join(size, [*by, "floor"]).select(*by, "floor", "_b.offset", "_b.matched", "n_obs", "n_ref")
