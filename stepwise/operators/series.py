"""Cleaning of counter series: persistence, plateaus, monotone repair, runs and totals.

reads(by, t, v, conf). Functions that carry state along a series run series by series
(applyInPandas), in parallel over series; the rest are windows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._range import asof
from .intervals import overlap_filter


def spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """df dealt by key to as many partitions as shuffles have: work in Python is slow for its bytes, and must not be coalesced by size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def per_series(df: DataFrame, by: Sequence[str], function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, order: Sequence[str] = ("t",)) -> DataFrame:
    """function on each series in order; its columns after the key. A series must fit a task."""
    keys = key_schema(df, by)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = function(rows.sort_values(list(order), kind="stable").reset_index(drop=True))
        for name, value in reversed(list(zip(by, key, strict=True))):
            out.insert(0, name, value)
        return out

    return spread(df, by).groupBy(*by).applyInPandas(run, f"{keys}, {schema}")


def key_schema(df: DataFrame, columns: Sequence[str]) -> str:
    """These columns of df as a schema."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema.fields)


def per_batch(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], function: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """function on many keys at a time: rows in order by key, and the position at which each key starts (and the end); what it returns is all columns of `schema`.

    For keys with few rows each, which one call apiece would be slow for. Keys are whole: the last of an Arrow
    batch waits for its other rows, so a key must fit a task, and no more than a batch and a key is held.
    """

    def cut(d: pd.DataFrame) -> np.ndarray:
        new = np.zeros(len(d), bool)
        for c in by:
            now, last = d[c], d[c].shift()
            new |= (now.ne(last) & ~(now.isna() & last.isna())).to_numpy(bool)
        new[0] = True
        return np.append(np.flatnonzero(new), len(d))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wait: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            wait.append(batch)
            if len(cut(pd.concat([wait[0].head(1), batch.tail(1)], ignore_index=True))) == 2:
                continue  # one key so far
            rows = pd.concat(wait, ignore_index=True)
            at = cut(rows)
            wait = [rows.iloc[at[-2] :]]
            yield function(rows.iloc[: at[-2]], at[:-1])
        if wait:
            rows = pd.concat(wait, ignore_index=True)
            yield function(rows, cut(rows))

    return spread(df, by).sortWithinPartitions(*by, *order).mapInPandas(run, schema)


def persistent(reads: DataFrame, by: Sequence[str], k: int = 2) -> DataFrame:
    """Reads whose value recurs within the next k reads."""
    order = Window.partitionBy(*by).orderBy("t")
    again = F.lit(False)
    for i in range(1, k + 1):
        again = again | F.coalesce(F.lead("v", i).over(order) == F.col("v"), F.lit(False))
    return reads.withColumn("_again", again).filter("_again").drop("_again")


def plateaus(reads: DataFrame, by: Sequence[str], least: int = 3, gap: float = 0.1, conf: float = 0.8) -> DataFrame:
    """by, t0, t1, v, n: runs of one value, each read less than gap after the one before, at least `least` reads, none below conf."""
    order = Window.partitionBy(*by).orderBy("t")
    same = (F.lag("v").over(order) == F.col("v")) & (F.col("t") - F.lag("t").over(order) < gap)
    rows = reads.filter("v IS NOT NULL").withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    runs = rows.groupBy(*by, "_run", "v").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count("*").alias("n"), F.min("conf").alias("_c"))
    return runs.filter((F.col("n") >= least) & (F.col("_c") >= conf)).select(*by, "t0", "t1", "v", "n")


def still_points(reads: DataFrame, by: Sequence[str], still: float) -> DataFrame:
    """by, t, v: midpoints of runs of one value that last at least `still`, whatever the gaps."""
    order = Window.partitionBy(*by).orderBy("t")
    rows = reads.filter("v IS NOT NULL").withColumn("_new", F.when(F.lag("v").over(order) == F.col("v"), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    runs = rows.groupBy(*by, "_run", "v").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    return runs.filter(F.col("b") - F.col("a") >= still).select(*by, ((F.col("a") + F.col("b")) / 2).alias("t"), "v")


def longest_rise(values: Sequence[float]) -> list[int]:
    """Indexes of a longest non-decreasing subsequence (patience sorting; the pile that a value lands on is the first whose top is greater)."""
    tops: list[float] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        p = bisect_right(tops, v)
        back.append(at[p - 1] if p else -1)
        if p == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[p], at[p] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def lnds(reads: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, t, v: a longest non-decreasing subsequence of each series, in order of t (ties: of v)."""
    rows = reads.select(*by, "t", "v").filter("v IS NOT NULL")

    def rise(d: pd.DataFrame, at: np.ndarray) -> pd.DataFrame:
        v = d["v"].tolist()
        return d.iloc[[a + i for a, b in pairwise(at.tolist()) for i in longest_rise(v[a:b])]]

    return per_batch(rows, by, (F.asc_nulls_last("t"), F.asc_nulls_last("v")), rise, key_schema(rows, rows.columns))


def monotone_stack(reads: DataFrame, by: Sequence[str]) -> DataFrame:
    """Reads that no later read undercuts: what is left when each read pops its larger predecessors."""
    after = Window.partitionBy(*by).orderBy("t").rowsBetween(1, Window.unboundedFollowing)
    low = F.min("v").over(after)
    return reads.filter("v IS NOT NULL").withColumn("_low", low).filter("_low IS NULL OR v <= _low").drop("_low")


def alternatives(v: int, cap: int) -> list[int]:
    """What a read may stand for: each 5 may be a 9, up to nine hundreds may be lost (within cap), a leading hundred may be one too many."""
    out = {0}
    for d in str(v):
        out = {10 * x + int(d) for x in out} | ({10 * x + 9 for x in out} if d == "5" else set())
    return sorted({x + 100 * k for x in out for k in range(10) if x + 100 * k <= cap} | {x - 100 for x in out if x >= 100})


def continuity_repair(reads: DataFrame, by: Sequence[str], rate: float = 60.0, cap: int = 10**9, confirm: int = 3) -> DataFrame:
    """by, t, v, raw: each read replaced by the alternative nearest to the last estimate within [est - 2, est + rate * dt + 3].

    Where no alternative fits: a read that is too high stays as it is, and the estimate too. A lower one looks at
    the next `confirm` reads: if two of them go on from the estimate modulo 100, digits are covered and the read goes; else, if there are
    two and all are under 0.6 of the estimate, it is a reset and the estimate starts anew; else it goes.
    """

    def repair(d: pd.DataFrame) -> pd.DataFrame:
        out, est, last = [], None, None
        values, times = d["v"].astype(int).tolist(), d["t"].tolist()
        for i, (t, v) in enumerate(zip(times, values, strict=True)):
            if est is None:
                est, last = v, t
                out.append((t, v, v))
                continue
            top = lambda at: est + rate * max(at - last, 1e-3) + 3  # noqa: B023, E731
            fit = [a for a in alternatives(v, cap) if est - 2 <= a <= top(t)]
            later = list(zip(times[i + 1 : i + 1 + confirm], values[i + 1 : i + 1 + confirm], strict=True))
            if fit:
                est, last = min(fit, key=lambda a: (abs(a - est), a)), t
                out.append((t, est, v))
            elif v >= est:
                out.append((t, v, v))
            elif sum(any(est - 2 <= w + 100 * k <= top(at) for k in range(10)) for at, w in later) < 2 <= len(later) and all(w < 0.6 * est for _, w in later):
                est, last = v, t
                out.append((t, v, v))
        return pd.DataFrame(out, columns=["t", "v", "raw"])

    kind = reads.schema["t"].dataType.simpleString()
    return per_series(reads.filter("v IS NOT NULL").select(*by, "t", "v"), by, repair, f"t {kind}, v long, raw long", ("t", "v"))


def cut_runs(reads: DataFrame, by: Sequence[str], fall: int = 3, held: int = 5) -> DataFrame:
    """reads with run (from 0): a new one where a read and those after it, `held` in all or as many as there are, lie more than `fall` below the read before."""
    order = Window.partitionBy(*by).orderBy("t", "v")
    before = F.lag("v").over(order)
    falls = F.max("v").over(order.rowsBetween(0, held - 1)) < before - fall
    return reads.filter("v IS NOT NULL").withColumn("_new", F.coalesce(falls, F.lit(False)).cast("int")).withColumn("run", F.sum("_new").over(order)).drop("_new")


def segment_runs(reads: DataFrame, by: Sequence[str], fall: int = 3, held: int = 5) -> DataFrame:
    """by, run, t, v: the runs of cut_runs, of each its longest chain that never falls."""
    return lnds(cut_runs(reads, by, fall, held).select(*by, "run", "t", "v"), [*by, "run"])


def confirmed_runs(reads: DataFrame, by: Sequence[str], gap: float, low: int = 15, rise: int = 20, ahead: int = 6, within: float = 0.6) -> DataFrame:
    """reads with run (from 0), for reads that persistent() gives: a fall, or more than `gap` without a read, starts a new one.

    A fall counts only at `low` or less and if the next `ahead` reads, as far as they are `within` of it, lie at most `rise` above it; else the read goes.
    """

    def run(d: pd.DataFrame) -> pd.DataFrame:
        t, v, keep, number, n = d["t"].tolist(), d["v"].tolist(), [], [], 0
        for i, (at, x) in enumerate(zip(t, v, strict=True)):
            if keep:
                fell = x < v[keep[-1]]
                if fell and not (x <= low and all(w <= x + rise for s, w in zip(t[i + 1 : i + 1 + ahead], v[i + 1 : i + 1 + ahead], strict=True) if s <= at + within)):
                    continue
                n += fell or at - t[keep[-1]] > gap
            keep.append(i)
            number.append(n)
        out = d.iloc[keep][["t", "v"]].copy()
        out["run"] = number
        return out

    kinds = {f.name: f.dataType.simpleString() for f in reads.schema.fields}
    return per_series(reads.filter("v IS NOT NULL").select(*by, "t", "v"), by, run, f"t {kinds['t']}, v {kinds['v']}, run long", ("t", "v"))


def reset_candidates(reads: DataFrame, by: Sequence[str], low: int = 12, fall: int = 3, follow: int = 8) -> DataFrame:
    """by, t, v, peak: reads of at most `low`, more than `fall` under the peak since the last candidate, with the next two reads at most v + follow."""

    def find(d: pd.DataFrame) -> pd.DataFrame:
        v, t, out, peak = d["v"].tolist(), d["t"].tolist(), [], -np.inf
        for i, x in enumerate(v):
            if x <= low and x < peak - fall and len(v) > i + 2 and max(v[i + 1], v[i + 2]) <= x + follow:
                out.append((t[i], x, peak))
                peak = x
            peak = max(peak, x)
        return pd.DataFrame(out, columns=["t", "v", "peak"])

    kinds = {f.name: f.dataType.simpleString() for f in reads.schema.fields}
    return per_series(reads.filter("v IS NOT NULL").select(*by, "t", "v"), by, find, f"t {kinds['t']}, v {kinds['v']}, peak {kinds['v']}", ("t", "v"))


def solve_runs(series: DataFrame, by: Sequence[str], most: int = 14) -> DataFrame:
    """by, chosen (which candidates are resets), peaks, error: the subset of resets whose run peaks sum nearest to the total.

    series(by, peaks array<long>, depths array<long>, resets int, total long, cap long):
    peaks[i] is the greatest value before candidate i since the candidate before it, the
    last one after all candidates; a subset of at most `resets` candidates cuts the
    series, and each run's peak is the greatest inside it. A last peak over cap costs 50.
    More than `most` candidates: the deepest stay (ties: the earliest). An error over
    max(3, 2 % of total) gives null. Ties: fewer resets, then the smaller mask.
    """
    k = F.size("depths")
    rank = F.transform("depths", lambda d, i: F.struct((-d).alias("d"), i.alias("i")))
    kept = F.array_sort(F.transform(F.slice(F.array_sort(rank), 1, most), lambda s: s["i"]))
    rows = series.withColumn("_kept", kept).withColumn("_mask", F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), F.least(k, F.lit(most))).cast("int") - 1)))
    chosen = F.filter("_kept", lambda i: F.col("_mask").bitwiseAND(F.pow(F.lit(2), F.array_position("_kept", i) - 1).cast("int")) != 0)
    rows = rows.withColumn("chosen", chosen).filter(F.size("chosen") <= F.col("resets"))
    starts = F.concat(F.array(F.lit(0)), F.transform("chosen", lambda i: i + 1))
    ends = F.concat(F.col("chosen"), F.array(F.size("peaks") - 1))
    runs = F.zip_with(starts, ends, lambda a, b: F.array_max(F.slice(F.col("peaks"), a + 1, b - a + 1)))
    rows = rows.withColumn("run_peaks", runs)
    total = F.aggregate("run_peaks", F.lit(0).cast("long"), lambda x, y: x + y)
    rows = rows.withColumn("error", F.abs(total - F.col("total")))
    rows = rows.withColumn("_cost", F.col("error") + F.when(F.element_at("run_peaks", -1) > F.col("cap"), 50).otherwise(0))
    best = rows.groupBy(*by).agg(F.min_by(F.struct("chosen", F.col("run_peaks").alias("peaks"), "error", "total"), F.struct("_cost", F.size("chosen"), "_mask")).alias("_b"))
    fits = F.col("_b.error") <= F.greatest(F.lit(3.0), 0.02 * F.col("_b.total"))
    return best.select(*by, F.when(fits, F.col("_b.chosen")).alias("chosen"), F.when(fits, F.col("_b.peaks")).alias("peaks"), "_b.error")


def best_chain(points: DataFrame, by: Sequence[str], rate: float = 25.0) -> DataFrame:
    """by, t0, t1, v: the chain of plateaus(by, t0, t1, v) with the best score.

    Each counts 1; time runs from the end of one to the start of the next, and must run. A step up of at most rate * time + 3 gains
    1 + 0.002 * min(step, 60); a reset (to at most 8 from over 20, more than 0.3 later) loses 1. Ties: the earlier plateau.
    """

    def solve(d: pd.DataFrame) -> pd.DataFrame:
        start, end, v = (d[c].to_numpy(float) for c in ("t0", "t1", "v"))
        score, back = np.ones(len(d)), np.full(len(d), -1)
        for j in range(1, len(d)):
            dv, dt = v[j] - v[:j], start[j] - end[:j]
            gain = np.where((dv >= 0) & (dv <= rate * dt + 3), 1 + 0.002 * np.minimum(dv, 60), np.where((v[j] <= 8) & (v[:j] > 20) & (dt > 0.3), -1.0, -np.inf))
            gain[dt <= 0] = -np.inf
            i = int(np.argmax(score[:j] + gain))
            if score[i] + gain[i] > 1:
                score[j], back[j] = score[i] + gain[i], i
        out, j = [], int(np.argmax(score)) if len(d) else -1
        while j >= 0:
            out.append(j)
            j = back[j]
        return d.iloc[out[::-1]][["t0", "t1", "v"]]

    kinds = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    return per_series(points.select(*by, "t0", "t1", "v"), by, solve, f"t0 {kinds['t0']}, t1 {kinds['t1']}, v {kinds['v']}", ("t0", "t1", "v"))


def cumulate(reads: DataFrame, totals: DataFrame, by: Sequence[str], per_break: int = 0) -> DataFrame:
    """by, t, cum: reads(by, run, t, v) offset by the peaks of the runs before (and per_break for each); values over total are dropped.

    totals(by, total): the peaks before the last run are scaled to close on the total,
    the last run is exact.
    """
    peaks = reads.groupBy(*by, "run").agg(F.max("v").alias("peak"))
    order, every = Window.partitionBy(*by).orderBy("run"), Window.partitionBy(*by)
    last = F.max("run").over(every)
    peaks = peaks.join(totals, list(by)).withColumn("_last", last)
    early = F.sum(F.when(F.col("run") < F.col("_last"), F.col("peak") + per_break)).over(every)
    final = F.max(F.when(F.col("run") == F.col("_last"), F.col("peak"))).over(every)
    before = F.coalesce(F.sum(F.col("peak") + per_break).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    scale = F.when(early > 0, (F.col("total") - final) / early).otherwise(1.0)
    offsets = peaks.select(*by, "run", "total", F.round(before * scale).cast("long").alias("_before"))
    rows = reads.join(offsets, [*by, "run"]).withColumn("cum", F.col("_before") + F.col("v"))
    return rows.filter("v <= total AND cum <= total").select(*by, "run", "t", "cum")


def window_mode(reads: DataFrame, windows: DataFrame, by: Sequence[str], window: str = "window", frames: int = 3, share: float = 0.5, events: DataFrame | None = None, jitter: float = 0.035) -> DataFrame:
    """by, window, error, n, frames: the commonest error (v - expected) of the reads inside a window, accepted if it has enough reads and share, all in one run.

    reads(by, t, v, run) and windows(by, window, s, e, expected) with s <= t <= e; windows
    of a series must not overlap. Ties go to the smaller error; else error is null. Reads within
    `jitter` of one of events(by, t) are left out: which side of it they fall on is open.
    """
    if events is not None:
        marks = events.select(*by, F.col("t").alias("_from"), F.col("t").alias("_next"))
        near = asof(reads.withColumn("_from", F.col("t") - jitter), marks, by, "_from", ["_next"], "forward")
        reads = near.filter(F.col("_next").isNull() | (F.col("_next") > F.col("t") + jitter)).drop("_from", "_next")
    own = asof(reads, windows.select(*by, F.col("s").alias("t"), F.col("s").alias("_s"), F.col("e").alias("_e"), "expected", window), by, "t", ["_s", "_e", "expected", window])
    rows = own.filter("t <= _e").withColumn("error", F.col("v") - F.col("expected"))
    counts = rows.groupBy(*by, window, "error").agg(F.count("*").alias("n"), F.countDistinct("run").alias("_runs"))
    best = counts.groupBy(*by, window).agg(F.sum("n").alias("frames"), F.min_by(F.struct("error", "n", "_runs"), F.struct(-F.col("n"), "error")).alias("_b"))
    good = (F.col("_b.n") >= frames) & (F.col("_b.n") >= share * F.col("frames")) & (F.col("_b._runs") == 1)
    return best.select(*by, window, F.when(good, F.col("_b.error")).alias("error"), F.col("_b.n").alias("n"), "frames")


def window_median_pull(reads: DataFrame, by: Sequence[str], most: int, cell: str = "cell", at: str = "at", span: float = 1.0) -> DataFrame:
    """by, cell, value: for each window, its reads pulled twice to that v + 100 k (k from 0 to 9, at most `most`) nearest to the median, then the read nearest to `at`.

    reads(by, cell, at, t, v). A hundred can only be restored, never taken off; a read over `most` stays. The median is the upper of two middle values, of
    the reads first, then of what they were pulled to. Pulled reads that still spread over 60 * span + 10 are taken raw. A window must fit a row.
    """
    keys = [*by, cell]
    rows = reads.filter("v IS NOT NULL").groupBy(*keys, at).agg(F.array_sort(F.collect_list(F.struct("t", "v"))).alias("w"))
    values = lambda w: F.transform(w, lambda x: x["v"])
    upper = lambda a: F.array_sort(a)[F.floor(F.size(a) / 2).cast("int")]

    def pulled(v: Column, middle: Column) -> Column:
        steps = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: v + 100 * k), lambda c: c <= most)
        return F.coalesce(F.array_min(F.transform(steps, lambda c: F.struct(F.abs(c - middle).alias("d"), c.alias("c"))))["c"], v)

    rows = rows.withColumn("_m", upper(values(F.col("w"))))
    rows = rows.withColumn("_p", F.transform(values(F.col("w")), lambda v: pulled(v, F.col("_m")))).withColumn("_m", upper(F.col("_p")))
    rows = rows.withColumn("_p", F.transform(values(F.col("w")), lambda v: pulled(v, F.col("_m"))))
    rows = rows.withColumn("_p", F.when(F.array_max("_p") - F.array_min("_p") > 60 * span + 10, values(F.col("w"))).otherwise(F.col("_p")))
    nearest = F.array_min(F.zip_with("w", "_p", lambda x, p: F.struct(F.abs(x["t"] - F.col(at)).alias("d"), x["t"].alias("t"), x["v"].alias("v"), p.alias("p"))))["p"]
    return rows.select(*keys, nearest.cast("long").alias("value"))


def measure_lag(reads: DataFrame, taps: DataFrame, by: Sequence[str], regions: DataFrame, width: float, apart: float = 0.25, early: float = 0.02, within: float = 0.30, default: float = 0.10, least: int = 15) -> DataFrame:
    """by, lag, n: the median time (the upper of two) from a tap to the counter's next step, `default` under `least` of them.

    Taps(by, t) count that are alone by `apart` and as far from every region(by, s, e). Steps are rises between neighbouring reads(by, t, v, run) of
    one run; the next one from `early` before the tap on counts, if it comes within `within`.
    """
    order = Window.partitionBy(*by).orderBy("t")
    before, after = F.col("t") - F.lag("t").over(order), F.lead("t").over(order) - F.col("t")
    alone = taps.select(*by, "t").withColumn("_a", before).withColumn("_b", after).filter((F.coalesce("_a", F.lit(1e18)) >= apart) & (F.coalesce("_b", F.lit(1e18)) >= apart)).drop("_a", "_b")
    spans = regions.select(*by, F.col("s").alias("ps"), F.col("e").alias("pe"))
    alone = overlap_filter(alone.withColumn("s", F.col("t")).withColumn("e", F.col("t")), spans, by, width, apart).drop("s", "e")
    up = (F.col("v") > F.lag("v").over(order)) & (F.col("run") == F.lag("run").over(order))
    steps = reads.withColumn("_up", up).filter("_up").select(*by, F.col("t").alias("_from"), F.col("t").alias("_step"))
    got = asof(alone.withColumn("_from", F.col("t") - early), steps, by, "_from", ["_step"], "forward").withColumn("_d", F.col("_step") - F.col("t")).filter(F.col("_d") <= within)
    ranked = got.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy("_d"))).withColumn("_n", F.count("*").over(Window.partitionBy(*by)))
    out = ranked.filter(F.col("_k") == F.floor(F.col("_n") / 2) + 1).select(*by, F.round("_d", 3).alias("lag"), F.col("_n").alias("n"))
    return out.withColumn("lag", F.when(F.col("n") >= least, F.col("lag")).otherwise(F.lit(default)))


def resample(series: DataFrame, by: Sequence[str], step: float) -> DataFrame:
    """by, t, v: the last value at or before each instant of a grid from the first to the last read; instants without a change of value are left out."""
    ends = series.groupBy(*by).agg(F.min("t").alias("a"), F.max("t").alias("b"))
    grid = ends.select(*by, F.explode(F.sequence(F.ceil(F.col("a") / step), F.floor(F.col("b") / step))).alias("_i")).withColumn("t", F.col("_i") * step)
    got = asof(grid, series.select(*by, "t", "v"), by, "t", ["v"]).select(*by, "t", "v")
    order = Window.partitionBy(*by).orderBy("t")
    return got.withColumn("_same", F.lag("v").over(order) == F.col("v")).filter("_same IS NULL OR NOT _same").drop("_same")
