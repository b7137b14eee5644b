"""Reconciliation, pricing and allocation: closing declared totals on observed ones."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ._range import asof, count_at
from .intervals import count_between, interpolate, overlap_filter
from .series import per_batch, per_series


def implied_totals(rows: DataFrame, holds: DataFrame, blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, taps, hold_events, implied, status for every block: tap rows plus hold events; a block with an error keeps its row with null counts.

    rows(by, beat), holds(by, events), blocks(by, error).
    """
    taps = rows.groupBy(*by).agg(F.countDistinct("beat").alias("taps"))
    events = holds.groupBy(*by).agg(F.sum("events").alias("hold_events"))
    out = blocks.join(taps, list(by), "left").join(events, list(by), "left")
    ok = F.col("error").isNull()
    zero = lambda c: F.when(ok, F.coalesce(c, F.lit(0)))
    out = out.withColumn("taps", zero("taps")).withColumn("hold_events", zero("hold_events"))
    return out.select(*by, "taps", "hold_events", (F.col("taps") + F.col("hold_events")).alias("implied"), F.coalesce("error", F.lit("ok")).alias("status"))


def sweep(implied: DataFrame, threshold: float = 0) -> DataFrame:
    """implied(implied, count1, count2, regions, blocks_alike, hold_events) with delta, pct, verdict and shape; at a threshold of 0 or below every disagreement stays, else those of more than that many percent.

    exact if either count agrees; else delta and pct are against the first count that
    exists. shape: duplicate_block, hold_less, single_region, over_ticked or under_ticked.
    """
    first = F.coalesce("count1", "count2")
    equal = F.coalesce((F.col("implied") == F.col("count1")) | (F.col("implied") == F.col("count2")), F.col("implied") == F.col("count1"), F.col("implied") == F.col("count2"), F.lit(False))
    rows = implied.withColumn("verdict", F.when(first.isNull(), "no_count").when(equal, "exact").otherwise("off"))
    off = F.col("verdict") == "off"
    rows = rows.withColumn("delta", F.when(off, F.col("implied") - first)).withColumn("pct", F.when(off, F.round(100 * (F.col("implied") - first) / first, 1)))
    shape = F.when(F.col("blocks_alike") > 1, "duplicate_block").when(F.col("hold_events") == 0, "hold_less").when(F.col("regions") == 1, "single_region").when(F.col("delta") > 0, "over_ticked").otherwise("under_ticked")
    rows = rows.withColumn("shape", F.when(off, shape))
    return rows if threshold <= 0 else rows.filter(~off | (F.abs("pct") > threshold))


def tally(df: DataFrame, *columns: str) -> DataFrame:
    """column, value, n: counts by each column on its own, in one pass (grouping sets)."""
    sets = df.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns]).agg(F.count("*").alias("n"), *(F.grouping(c).alias(f"_g_{c}") for c in columns))
    which = F.coalesce(*(F.when(F.col(f"_g_{c}") == 0, c) for c in columns))
    value = F.coalesce(*(F.when(F.col(f"_g_{c}") == 0, F.col(c).cast("string")) for c in columns))
    return sets.select(which.alias("column"), value.alias("value"), "n")


def observe_holds(anchors: DataFrame, taps: DataFrame, regions: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, region, lo, hi, events, pinned: what the counter moved over each region beyond the taps.

    The cuts lie midway between regions(by, region, s, e), the outer ones at the region's
    own ends, so each event has one owner. The value at a cut is that of the last
    anchor(by, t, cum) at or before it; a region is unpinned (events null) where a cut has
    no anchor or both cuts share one.
    """
    order = Window.partitionBy(*by).orderBy("s")
    lo = F.coalesce((F.lag("e").over(order) + F.col("s")) / 2, F.col("s").cast("double"))
    hi = F.coalesce((F.col("e") + F.lead("s").over(order)) / 2, F.col("e").cast("double"))
    cuts = regions.select(*by, "region", lo.alias("lo"), hi.alias("hi"))
    marks = anchors.select(*by, F.col("t").cast("double").alias("_t"), F.struct(F.col("t").alias("t"), F.col("cum").alias("cum")).alias("_m"))
    left = asof(cuts.withColumn("_t", F.col("lo")), marks, by, "_t", ["_m"]).withColumnRenamed("_m", "_a")
    both = asof(left.withColumn("_t", F.col("hi")), marks, by, "_t", ["_m"])
    counted = count_between(taps.select(*by, F.col("t").cast("double").alias("t")), both.drop("_t"), by, out="_taps")
    pinned = F.coalesce(F.col("_a.t") < F.col("_m.t"), F.lit(False))
    events = F.when(pinned, F.col("_m.cum") - F.col("_a.cum") - F.col("_taps"))
    return counted.select(*by, "region", "lo", "hi", events.alias("events"), pinned.alias("pinned"))


def slack_screen(anchors: DataFrame, taps: DataFrame, by: Sequence[str], zone: float = 15, bad: float = -35, odd: float = -15) -> DataFrame:
    """by, low, high, zones, tail, verdict: cum - taps for each zone of time that has an anchor; low is at most 0.

    The head is the first fifth of the zones (one at least); tail is the lowest slack past it,
    0 if nothing is. `fine` if low is `odd` or more; `recovers` if the tail is `bad` or more;
    `suspect` if the tail doesn't go below its own first half; else `deepens`.
    """
    rows = count_at(taps, anchors, by, "t", "t", "_taps").withColumn("slack", F.col("cum") - F.col("_taps")).withColumn("_z", F.floor(F.col("t") / zone))
    zones = rows.groupBy(*by, "_z").agg(F.min("slack").alias("lo"), F.max("slack").alias("hi"))
    zones = zones.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy("_z"))).withColumn("_n", F.count("*").over(Window.partitionBy(*by)))
    head = F.greatest(F.lit(1), F.floor(F.col("_n") / 5))
    half = head + F.greatest(F.lit(1), F.floor((F.col("_n") - head) / 2))
    past = lambda upto: F.coalesce(F.min(F.when((F.col("_i") > head) & upto, F.col("lo"))), F.lit(0))
    agg = zones.groupBy(*by).agg(F.least(F.min("lo"), F.lit(0)).alias("low"), F.max("hi").alias("high"), F.count("*").alias("zones"), past(F.lit(True)).alias("tail"), past(F.col("_i") <= half).alias("_half"))
    verdict = F.when(F.col("low") >= odd, "fine").when(F.col("tail") >= bad, "recovers").when(F.col("tail") > F.col("_half"), "suspect").otherwise("deepens")
    return agg.select(*by, "low", "high", "zones", "tail", verdict.alias("verdict"))


def run_drift(runs: DataFrame, taps: DataFrame, holds: DataFrame, by: Sequence[str], width: float, lag: float = 0.12, least: int = 5, climb: int = 5) -> DataFrame:
    """by, run, reads, drift, held: for each run of reads(by, run, t, v) long and steep enough, its counter's climb less the taps, with the counter behind by lag; held where a hold(by, ps, pe) overlaps."""
    ends = runs.groupBy(*by, "run").agg(F.min("t").alias("s"), F.max("t").alias("e"), F.min_by("v", "t").alias("_v0"), F.max_by("v", "t").alias("_v1"), F.count("*").alias("reads"))
    ends = ends.filter((F.col("reads") >= least) & (F.col("_v1") - F.col("_v0") >= climb)).withColumn("lo", F.col("s") - lag).withColumn("hi", F.col("e") - lag)
    kind = taps.schema["t"].dataType
    counted = count_between(taps, ends.withColumn("lo", F.col("lo").cast(kind)).withColumn("hi", F.col("hi").cast(kind)), by, out="_taps")
    held = overlap_filter(counted, holds, by, width, keep="count")
    return held.select(*by, "run", "reads", (F.col("_v1") - F.col("_v0") - F.col("_taps")).alias("drift"), (F.col("n_spans") > 0).alias("held"))


def excess_clusters(reads: DataFrame, taps: DataFrame, by: Sequence[str], gap: float = 1.5, join: float = 0.6, least: int = 1, lag: float = 0.15) -> DataFrame:
    """by, t0, t1, excess: where the counter rises by more than the taps, which it shows `lag` late.

    A rise is measured from the instant its lower value was first read; repeats of a value
    change nothing. A fall, or more than `gap` without a rise, starts anew and ends the open
    cluster. Rises beyond the taps within `join` of the open cluster's end belong to it, later
    ones open another; a shortfall takes from the open cluster wherever it is. Clusters under `least` go.
    """
    kind = reads.schema["t"].dataType
    rows = count_at(taps, reads.withColumn("_at", (F.col("t") - lag).cast(kind)), by, "t", "_at", "n").select(*by, "t", "v", "n")

    def rises(d: pd.DataFrame):
        """(from, to, climb less taps) of each rise; None where a stretch ends."""
        since = None
        for now in zip(d["t"].tolist(), d["v"].tolist(), d["n"].tolist(), strict=True):
            if since is None or now[1] < since[1] or now[0] - since[0] > gap:
                yield None
            elif now[1] == since[1]:
                continue
            else:
                yield since[0], now[0], now[1] - since[1] - (now[2] - since[2])
            since = now

    def gather(d: pd.DataFrame) -> pd.DataFrame:
        out, is_open = [], False
        for rise in rises(d):
            if rise is None:
                is_open = False
                continue
            start, end, more = rise
            if more > 0 and not (is_open and start - out[-1][1] <= join):
                out.append([start, end, more])
                is_open = True
            elif more and is_open:
                out[-1][1] = end if more > 0 else out[-1][1]
                out[-1][2] += more
        return pd.DataFrame([o for o in out if o[2] >= least], columns=["t0", "t1", "excess"])

    return per_series(rows, by, gather, f"t0 {kind.simpleString()}, t1 {kind.simpleString()}, excess long")


def deficit_segments(reads: DataFrame, taps: DataFrame, by: Sequence[str], lag: float = 0.15, least: float = 0.3) -> DataFrame:
    """by, t0, t1, deficit, n: runs of a constant (taps at t - lag) - v that last long enough."""
    rows = count_at(taps, reads.withColumn("_at", (F.col("t") - lag).cast(reads.schema["t"].dataType)), by, "t", "_at", "_taps").withColumn("deficit", F.col("_taps") - F.col("v"))
    order = Window.partitionBy(*by).orderBy("t")
    rows = rows.withColumn("_new", F.when(F.lag("deficit").over(order) == F.col("deficit"), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    return rows.groupBy(*by, "_run", "deficit").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count("*").alias("n")).filter(F.col("t1") - F.col("t0") >= least).drop("_run")


def quiet_points(quiet: DataFrame, by: Sequence[str], span: float) -> DataFrame:
    """by, t, v: instants taken greedily, each at least `span` after the one before."""

    def choose(d: pd.DataFrame) -> pd.DataFrame:
        keep, last = [], -np.inf
        for i, t in enumerate(d["t"].tolist()):
            if t - last >= span:
                keep.append(i)
                last = t
        return d.iloc[keep][["t", "v"]]

    kinds = {f.name: f.dataType.simpleString() for f in quiet.schema.fields}
    return per_series(quiet.select(*by, "t", "v"), by, choose, f"t {kinds['t']}, v {kinds['v']}", ("t", "v"))


def judge_stretches(points: DataFrame, rows: DataFrame, holds: DataFrame, by: Sequence[str], width: float) -> DataFrame:
    """by, exact, off, held: stretches between neighbouring points(by, t, v): the counter's move against the row starts; held ones aren't judged."""
    order = Window.partitionBy(*by).orderBy("t")
    pairs = points.select(*by, F.lag("t").over(order).alias("lo"), F.col("t").alias("hi"), (F.col("v") - F.lag("v").over(order)).alias("_d")).filter("lo IS NOT NULL")
    counted = count_between(rows, pairs, by, out="_n").withColumn("s", F.col("lo")).withColumn("e", F.col("hi"))
    held = overlap_filter(counted, holds, by, width, keep="count")
    free = F.col("n_spans") == 0
    return held.groupBy(*by).agg(F.count_if(free & (F.col("_d") == F.col("_n"))).alias("exact"), F.count_if(free & (F.col("_d") != F.col("_n"))).alias("off"), F.count_if(~free).alias("held"))


def price_clusters(regions: DataFrame, readings: DataFrame, by: Sequence[str], span: float) -> DataFrame:
    """by, cluster, s, e, regions, price, refusal: regions priced by the readings around them.

    regions(by, s, e, ticks); readings(by, t, error, run): counter less file. Each region
    has the last reading at most span before it and the first at most span after;
    neighbours with no reading between them are one cluster, priced ticks + the change of
    error. Refused: no_before, no_after, run_change, falls (a negative price).
    """
    take = ["error", "run", "rt"]
    r = readings.withColumn("rt", F.col("t"))
    before = asof(regions.withColumn("t", F.col("s")), r, by, "t", take)
    for c in take:
        before = before.withColumnRenamed(c, f"b_{c}")
    both = asof(before.withColumn("t", F.col("e")), r, by, "t", take, "forward")
    order = Window.partitionBy(*by).orderBy("s", "e")
    new = F.when(F.lag("rt").over(order) <= F.col("b_rt"), 1).otherwise(0)
    rows = both.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = rows.groupBy(*by, "cluster").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("regions"), F.sum("ticks").alias("_ticks"),
        F.min_by(F.struct("b_error", "b_run", "b_rt"), F.struct("s", "e")).alias("_b"), F.max_by(F.struct("error", "run", "rt"), F.struct("s", "e")).alias("_a"),
    )
    price = F.col("_ticks") + F.col("_a.error") - F.col("_b.b_error")
    refusal = F.when(F.col("_b.b_rt").isNull() | (F.col("s") - F.col("_b.b_rt") > span), "no_before").when(F.col("_a.rt").isNull() | (F.col("_a.rt") - F.col("e") > span), "no_after").when(F.col("_a.run") != F.col("_b.b_run"), "run_change").when(price < 0, "falls")
    return out.select(*by, "cluster", "s", "e", "regions", F.when(refusal.isNull(), price).alias("price"), refusal.alias("refusal"))


def price_rails(rails: DataFrame, reads: DataFrame, taps: DataFrame, resets: DataFrame, by: Sequence[str], lag: float = 0.12) -> DataFrame:
    """by, s, e, price, refusal: for each rail, the counter's move from the last read before its head to the first after its tail, less the taps between (the rail's own head row isn't one).

    reads(by, t, v), taps(by, t), resets(by, t). Refused: no_bracket, reset.
    """
    kind = rails.schema["s"].dataType
    r = reads.select(*by, "t", F.col("t").alias("rt"), "v")
    a = asof(rails.withColumn("t", F.col("s")), r, by, "t", ["rt", "v"], strict=True).withColumnRenamed("rt", "_t0").withColumnRenamed("v", "_v0")
    b = asof(a.withColumn("t", F.col("e")), r, by, "t", ["rt", "v"], "forward", strict=True).withColumnRenamed("rt", "_t1").withColumnRenamed("v", "_v1").drop("t")
    b = b.withColumn("lo", (F.col("_t0") - lag).cast(kind)).withColumn("hi", (F.col("_t1") - lag).cast(kind))
    counted = count_between(taps.select(*by, "t"), b, by, out="_taps")
    reset = count_between(resets.select(*by, "t"), counted.drop("lo", "hi").withColumn("lo", F.col("_t0")).withColumn("hi", F.col("_t1")), by, out="_resets")
    own = taps.select(*by, F.col("t").alias("s"), F.lit(1).alias("_own")).distinct()
    rows = reset.join(own, [*by, "s"], "left")
    inside = F.coalesce(F.when((F.col("s") > F.col("_t0") - lag) & (F.col("s") <= F.col("_t1") - lag), F.col("_own")), F.lit(0))
    refusal = F.when(F.col("_t0").isNull() | F.col("_t1").isNull(), "no_bracket").when(F.col("_resets") > 0, "reset")
    return rows.select(*by, "s", "e", F.when(refusal.isNull(), F.col("_v1") - F.col("_v0") - F.col("_taps") + inside).alias("price"), refusal.alias("refusal"))


def allocate(items: DataFrame, by: Sequence[str], total: str = "total", weight: str = "weight", order: str = "item", pinned: str | None = None, method: str = "remainder") -> DataFrame:
    """items with share: whole numbers that close exactly on each key's total (one total a key).

    Pinned items keep their value; the rest of the total, at least 0, goes by weight.
    What rounding down leaves goes to the first item, to the largest weight, or (remainder) one
    each by largest remainder; ties by order. Without weight it goes by equal parts.
    """
    every = Window.partitionBy(*by)
    fixed = F.lit(None).cast("long") if pinned is None else F.col(pinned)
    rows = items.withColumn("_pin", fixed)
    free = F.col("_pin").isNull()
    left = F.greatest(F.lit(0), F.col(total) - F.coalesce(F.sum("_pin").over(every), F.lit(0)))
    weights = F.sum(F.when(free, F.col(weight))).over(every)
    n = F.count_if(free).over(every)
    rows = rows.withColumn("_left", left).withColumn("_part", F.when(weights > 0, F.col(weight)).otherwise(1)).withColumn("_whole", F.when(weights > 0, weights).otherwise(n))
    if isinstance(items.schema[weight].dataType, T.IntegralType):
        down, over = F.expr("_left * _part div _whole"), F.expr("_left * _part % _whole / _whole")
    else:
        exact = F.col("_left") * F.col("_part") / F.col("_whole")
        down, over = F.floor(exact + F.lit(1e-9)).cast("long"), F.round(exact - F.floor(exact + F.lit(1e-9)), 9)
    rows = rows.withColumn("_down", F.when(free, down)).withColumn("_over", F.when(free, over))
    spare = F.col("_left") - F.sum("_down").over(every)
    rows = rows.withColumn("_spare", spare)
    if method == "remainder":
        rank = F.row_number().over(every.orderBy(F.desc("_over"), order))
        extra = F.when(free & (rank <= F.col("_spare")), 1).otherwise(0)
    else:
        rank = F.row_number().over(every.orderBy(*([F.asc(F.col("_pin").isNotNull()), order] if method == "first" else [F.asc(F.col("_pin").isNotNull()), F.desc(weight), order])))
        extra = F.when(free & (rank == 1), F.col("_spare")).otherwise(0)
    return rows.withColumn("share", F.coalesce("_pin", F.col("_down") + extra).cast("long")).select(*items.columns, "share")


def _solve_many(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a[k] x = b[k] for each k by elimination with pivoting; a column without a pivot gets 0. For a few unknowns, without LAPACK's threads in forked workers."""
    m, n = np.concatenate((a, b[:, :, None]), axis=2).astype(float), b.shape[1]
    for i in range(n):
        p = i + np.argmax(np.abs(m[:, i:, i]), axis=1)
        sure = np.abs(m[np.arange(len(m)), p, i]) >= 1e-12
        m[~sure, i] = 0
        k, p = np.flatnonzero(sure), p[sure]
        top = m[k, p]
        m[k, p] = m[k, i]
        top /= top[:, i, None]
        rest = m[k]
        rest -= rest[:, :, i, None] * top[:, None, :]
        rest[:, i] = top
        m[k] = rest
    return m[:, :, n]


def nnls_many(g: np.ndarray, h: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson, for problems of one size at a time: g[k] = A'A, h[k] = A'b."""
    n = h.shape[1]
    x, free, going = np.zeros(h.shape), np.zeros(h.shape, bool), np.ones(len(h), bool)
    enough = tolerance * np.maximum(1.0, np.abs(h).max(axis=1))
    for _ in range(3 * n + 3):
        slope = h - (g @ x[:, :, None])[:, :, 0]
        slope[free] = -np.inf
        j = np.argmax(slope, axis=1)
        going &= slope[np.arange(len(h)), j] > enough
        k = np.flatnonzero(going)
        if not len(k):
            break
        free[k, j[k]] = True
        while len(k):
            f = free[k]
            z = _solve_many(np.where(f[:, :, None] & f[:, None, :], g[k], np.eye(n)), np.where(f, h[k], 0))
            down = f & (z <= 0)
            back = down.any(axis=1)
            x[k[~back]] = z[~back]
            k, y, z, down = k[back], x[k[back]], z[back], down[back]
            step = np.where(down, y / np.maximum(y - z, 1e-300), np.inf).min(axis=1, initial=np.inf)
            y = y + step[:, None] * (z - y)
            free[k] &= y > 1e-12
            x[k] = np.where(free[k], y, 0)
            k = k[free[k].any(axis=1)]
    return x


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """One problem of nnls_many()."""
    return nnls_many((a.T @ a)[None], (a.T @ b)[None], tolerance)[0]


def solve_counts(equations: DataFrame, totals: DataFrame, by: Sequence[str], closure: float = 50) -> DataFrame:
    """by, region, count, estimate: whole counts of regions from overlap equations.

    equations(by, row, region, share, value): each row says sum(share * count) = value;
    totals(by, total) close it with weight `closure`. Non-negative least squares, rounded down; what is
    missing from the total, or too much, goes one by one to the largest fractions, in turn, and nothing falls under 0.
    Keys of one shape are solved together, a batch at a time.
    """
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in equations.select(*by).schema.fields)

    def place(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each value among the distinct ones of its group, their number by group, and where (in order) each first comes."""
        order = np.lexsort((value, group))
        g, v = group[order], value[order]
        new = np.append(True, (g[1:] != g[:-1]) | (v[1:] != v[:-1]))
        number = np.bincount(g[new])
        first = np.concatenate(([0], np.cumsum(number)))[:-1]
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1 - first[g]
        return at, number, order[new]

    def solve(d: pd.DataFrame, start: np.ndarray) -> pd.DataFrame:
        group = np.repeat(np.arange(len(start) - 1), np.diff(start))
        region_at, n_regions, regions = place(group, d["region"].to_numpy())
        row_at, n_rows, _ = place(group, d["row"].to_numpy())
        share, value, total = d["share"].to_numpy(float), d["value"].to_numpy(float), d["_total"].to_numpy()[start[:-1]].astype(np.int64)
        first = np.concatenate(([0], np.cumsum(n_regions)))[:-1]
        count, estimate = np.zeros(len(regions), np.int64), np.zeros(len(regions))
        for n, m in np.unique(np.stack((n_regions, n_rows), axis=1), axis=0).tolist():
            some = np.flatnonzero((n_regions == n) & (n_rows == m))
            k = np.full(len(n_regions), -1)
            k[some] = np.arange(len(some))
            here = k[group] >= 0
            a, b = np.zeros((len(some), m + 1, n)), np.zeros((len(some), m + 1))
            np.add.at(a, (k[group[here]], row_at[here], region_at[here]), share[here])
            b[k[group[here]], row_at[here]] = value[here]
            a[:, m], b[:, m] = closure, closure * total[some]
            turned = a.transpose(0, 2, 1)
            x = nnls_many(turned @ a, (turned @ b[:, :, None])[:, :, 0])
            whole = np.floor(x + 1e-9).astype(np.int64)
            rank = np.argsort(np.argsort(-np.round(x - whole, 9), axis=1, kind="stable"), axis=1)
            rest = total[some] - whole.sum(axis=1)
            each, more = np.divmod(np.abs(rest), n)
            whole += np.sign(rest)[:, None] * (each[:, None] + (rank < more[:, None]))
            at = first[some][:, None] + np.arange(n)
            count[at], estimate[at] = np.maximum(whole, 0), x
        out = d.iloc[regions][[*by, "region"]].reset_index(drop=True)
        return out.assign(count=count, estimate=estimate)

    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    ends = totals.dropDuplicates(list(by)).select(*(F.col(c).alias(f"_k_{c}") for c in by), F.col("total").alias("_total"))
    rows = equations.join(ends, same).select(*by, "row", "region", "share", "value", "_total")
    return per_batch(rows, by, ["region", "row"], solve, f"{keys}, region long, count long, estimate double")


def residuals(equations: DataFrame, counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, row, residual: what each of the equations of solve_counts() says beyond the rounded counts(by, region, count)."""
    fit = equations.join(counts.select(*by, "region", "count"), [*by, "region"], "left")
    return fit.groupBy(*by, "row").agg((F.first("value") - F.sum(F.col("share") * F.coalesce("count", F.lit(0)))).alias("residual"))


def raise_floors(targets: DataFrame, by: Sequence[str], near: float = 3.0) -> DataFrame:
    """by, region, target, gave: targets under their floor raised, and how much each region gave for that; targets are null for a whole key that has too little to give.

    targets(by, region, t, target, floor). Units come from the dominant region (the largest, at
    least half of all) while it is over its floor; else one by one from the region with most over its
    floor (ties: the nearest, then the earliest) within `near`, or anywhere if none there has any.
    Raised regions give nothing. The total stays.
    """

    def lift(before: list[int], low: list[int], t: list[float]) -> tuple[list[int | None], list[int]]:
        short = [b < f for b, f in zip(before, low, strict=True)]
        spare = [0 if s else b - f for s, b, f in zip(short, before, low, strict=True)]
        if sum(f - b for s, b, f in zip(short, before, low, strict=True) if s) > sum(spare):
            return [None] * len(before), [0] * len(before)
        top = max(range(len(before)), key=before.__getitem__)
        main = top if 2 * before[top] >= sum(before) and not short[top] else None
        left = spare.copy()
        for i in range(len(before)):
            need = low[i] - before[i] if short[i] else 0
            if main is not None:
                took = min(need, left[main])
                left[main] -= took
                need -= took
            for _ in range(need):
                some = [k for k, n in enumerate(left) if n > 0]
                close = [k for k in some if abs(t[k] - t[i]) <= near]
                left[min(close or some, key=lambda k: (-left[k], abs(t[k] - t[i]), k))] -= 1
        gave = [a - b for a, b in zip(spare, left, strict=True)]
        return [f if s else b - g for s, f, b, g in zip(short, low, before, gave, strict=True)], gave

    def lift_all(d: pd.DataFrame, start: np.ndarray) -> pd.DataFrame:
        before, low, t = d["target"].to_numpy(np.int64), d["floor"].to_numpy(np.int64), d["t"].to_numpy(float)
        target, gave = pd.array(before, "Int64"), np.zeros(len(d), np.int64)
        for k in np.flatnonzero(np.logical_or.reduceat(before < low, start[:-1])).tolist():
            part = slice(start[k], start[k + 1])
            new, gave[part] = lift(before[part].tolist(), low[part].tolist(), t[part].tolist())
            target[part] = pd.array(new, "Int64")
        return d[[*by, "region"]].assign(target=target, gave=gave)

    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in targets.select(*by).schema.fields)
    kind = targets.schema["region"].dataType.simpleString()
    return per_batch(targets.select(*by, "region", "t", "target", "floor"), by, ["t", "region"], lift_all, f"{keys}, region {kind}, target long, gave long")


def search_rates(regions: DataFrame, rates: DataFrame, unit: int) -> DataFrame:
    """regions(key, head, tail, rate, target) with new_rate: the rate nearest to the old one (ties: the smaller) at which the region's lattice count is the target; null if none.

    rates(candidate) is a small table of whole rates; beats are whole numbers of 1/unit.
    """
    count = F.floor(F.col("tail") * F.col("candidate") / unit) - F.floor(F.col("head") * F.col("candidate") / unit)
    found = regions.crossJoin(F.broadcast(rates)).filter(count == F.col("target"))  # a rule table of fixed size
    best = found.groupBy("key").agg(F.min_by("candidate", F.struct(F.abs(F.col("candidate") - F.col("rate")), "candidate")).alias("new_rate"))
    return regions.join(best, "key", "left")


def audit_regions(regions: DataFrame, anchors: DataFrame, taps: DataFrame, by: Sequence[str], most_rate: float = 30, cover: float = 0.6) -> DataFrame:
    """by, compared, worst_region, worst: how much each region's ticks are more than the counter curve's rise less the taps, in whole numbers; worst_region is null where none differs.

    regions(by, region, s, e, ticks), anchors(by, t, cum). Compared only where ticks are at
    most most_rate a unit of time, at least 3 distinct anchor values lie inside, they cover
    enough of the region, and it lies inside the curve.
    """
    at = anchors.groupBy(*by, "t").agg(F.max("cum").alias("y"))
    lo = interpolate(at, regions.select(*by, "region", F.col("s").alias("t")), by).select(*by, "region", F.col("y").alias("_y0"))
    hi = interpolate(at, regions.select(*by, "region", F.col("e").alias("t")), by).select(*by, "region", F.col("y").alias("_y1"))
    inside = asof(anchors, regions.select(*by, F.col("s").alias("t"), "region", F.col("e").alias("_e")), by, "t", ["region", "_e"]).filter("t <= _e").groupBy(*by, "region").agg(F.countDistinct("cum").alias("_n"), (F.max("t") - F.min("t")).alias("_span"))
    ends = anchors.groupBy(*by).agg(F.min("t").alias("_a"), F.max("t").alias("_b"))
    rows = count_between(taps, regions.withColumn("lo", F.col("s")).withColumn("hi", F.col("e")), by, out="_taps")
    rows = rows.join(lo, [*by, "region"]).join(hi, [*by, "region"]).join(inside, [*by, "region"]).join(ends, list(by))
    good = (F.col("ticks") <= most_rate * (F.col("e") - F.col("s"))) & (F.col("_n") >= 3) & (F.col("_span") >= cover * (F.col("e") - F.col("s"))) & (F.col("s") >= F.col("_a")) & (F.col("e") <= F.col("_b"))
    rows = rows.filter(good).withColumn("_d", F.bround(F.col("ticks").cast("double"), 0).cast("long") - F.bround(F.round(F.col("_y1") - F.col("_y0") - F.col("_taps"), 6), 0).cast("long"))
    return rows.groupBy(*by).agg(F.count("*").alias("compared"), F.max_by(F.when(F.col("_d") != 0, F.col("region")), F.struct(F.abs("_d"), -F.col("region"))).alias("worst_region"), F.max_by("_d", F.struct(F.abs("_d"), -F.col("region"))).alias("worst"))


def verdict_ladder(df: DataFrame, rules: Sequence[tuple[Column, str, str]], otherwise: tuple[str, str] = ("PARK", "no_rule")) -> DataFrame:
    """df with verdict and reason: those of the first rule (condition, verdict, reason) that holds; a null condition doesn't hold."""
    verdict, reason = F.lit(otherwise[0]), F.lit(otherwise[1])
    for condition, v, r in reversed(list(rules)):
        verdict, reason = F.when(condition, v).otherwise(verdict), F.when(condition, r).otherwise(reason)
    return df.withColumn("verdict", verdict).withColumn("reason", reason)


def closer(df: DataFrame, ours: str = "ours", theirs: str = "theirs", ref: str = "ref") -> DataFrame:
    """df with verdict (both_exact, theirs_exact, ours_exact, theirs_closer, ours_closer, same_distance, same_no_reference, differs_no_reference, not_converted), gain and rank for the report's order."""
    a, b = F.abs(F.col(ours) - F.col(ref)), F.abs(F.col(theirs) - F.col(ref))
    verdict = (
        F.when(F.col(ours).isNull() | F.col(theirs).isNull(), "not_converted").when(F.col(ref).isNull() & (F.col(ours) == F.col(theirs)), "same_no_reference").when(F.col(ref).isNull(), "differs_no_reference").when((a == 0) & (b == 0), "both_exact")
        .when(b == 0, "theirs_exact").when(a == 0, "ours_exact").when(b < a, "theirs_closer").when(a < b, "ours_closer").otherwise("same_distance")
    )
    names = ("theirs_exact", "theirs_closer", "both_exact", "same_distance", "same_no_reference", "differs_no_reference", "ours_closer", "ours_exact", "not_converted")
    out = df.withColumn("verdict", verdict).withColumn("gain", a - b)
    return out.withColumn("rank", F.array_position(F.array(*map(F.lit, names)), F.col("verdict")))


def worklist(df: DataFrame, group: str, name: str, keep: Column, owner_rank: Sequence[Column], nearest_first: Sequence[Column], items: int | None = None) -> DataFrame:
    """group, n, names: rows that `keep` holds for, one owner for each name (first by owner_rank), grouped, names in order of nearest_first; at most `items` names, if given."""
    own = Window.partitionBy(name).orderBy(*owner_rank)
    rows = df.filter(keep).withColumn("_k", F.row_number().over(own)).filter("_k = 1")
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*nearest_first))
    rows = rows.withColumn("_r", rank)
    listed = rows if items is None else rows.filter(F.col("_r") <= items)
    names = F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(name)))), lambda s: s[name])
    return rows.groupBy(group).agg(F.count("*").alias("n")).join(listed.groupBy(group).agg(names.alias("names")), group)


def derive_manifest(census: DataFrame, imported: DataFrame, now: DataFrame) -> DataFrame:
    """chart, state: repaired (known wrong, now exact), upstream_exact (exact at import, block unchanged), still_wrong, or other.

    census(chart, was_exact), imported(chart, sha), now(chart, sha, exact).
    """
    rows = census.join(now.select("chart", F.col("sha").alias("_now"), "exact"), "chart", "left").join(imported.select("chart", F.col("sha").alias("_was")), "chart", "left")
    state = F.when(~F.col("was_exact") & F.coalesce("exact", F.lit(False)), "repaired").when(F.col("was_exact") & (F.col("_now") == F.col("_was")), "upstream_exact").when(~F.coalesce("exact", F.lit(False)), "still_wrong").otherwise("other")
    return rows.select("chart", state.alias("state"))

