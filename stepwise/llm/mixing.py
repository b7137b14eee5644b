"""Mixing sources to target weights by entropy balancing.

Every document starts with weight 1, and each source's tokens must come to its target. The
rates that keep the least relative entropy to that start are exponential tilts: a
document's rate is exp(lambda of its source * its size), at most the cap. lambda
maximises a convex dual, which Newton iterations solve for all sources at once, each one
an aggregation over the counts of (source, size), so documents are read once. A step that
leaves the bracket of the optimum is replaced by its middle, so the iterations always end. Rates
become whole copies by systematic rounding along the order of sizes in a source, so a
source's tokens come near its target; then a few documents of falling size, two for each
power of two, take one copy more or less to close the rest.

Sources are rows of a table throughout, so there may be any number of them. Documents
of one source and size, which may be a third of all, are dealt to parts by a hash, the
more the more documents there are; ranks are counted in parts and moved by what lies
before.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators._range import numbered

#: Documents for each part that the documents of one source and size are dealt to for counting; the fewest parts.
PART_ROWS, PARTS = 500_000, 16


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _joined(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """left with the other columns of right where the keys are equal, null being equal to null."""
    other = {k: f"{k} of the right side" for k in keys}
    same = F.lit(True)
    for k, o in other.items():
        same &= F.col(k).eqNullSafe(F.col(o))
    return left.join(right.withColumnsRenamed(other), same, how).drop(*other.values())


def with_targets(totals: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """source, total, target of totals(source, total): shares of the sum by weight; a target over cap times its total stops there, and the excess is shared anew.

    Sources by code point, null last, take the weights in turn. A round is one sum over the sources that
    no cap has stopped yet.
    """
    order = numbered(totals, [F.col("source").asc_nulls_last()], "at")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("at") % len(weights) + 1).cast("int"))
    rows = order.select("source", "total", weight.alias("weight"), F.lit(False).alias("full")).checkpoint()
    while True:
        full, left = F.coalesce(F.sum(F.when(F.col("full"), F.col("total"))), F.lit(0)), F.sum(F.when(~F.col("full"), F.col("weight")))
        r = rows.agg((F.coalesce(F.sum("total"), F.lit(0)) - cap * full).alias("rest"), left.alias("left")).first()
        unit = r.rest / r.left if r.left else 0.0
        over = ~F.col("full") & (F.col("weight") * unit > cap * F.col("total"))
        if rows.filter(over).isEmpty():
            return rows.select("source", "total", F.when(F.col("full"), cap * F.col("total")).otherwise(F.col("weight") * unit).alias("target"))
        rows = rows.withColumn("full", F.col("full") | over).checkpoint()


def tilted_rate(cap: float) -> Column:
    """The rate of a document of a size, by its source's tilt and scale: exp(tilt * size / scale), at most cap."""
    return F.exp(F.least(F.lit(math.log(cap)), F.coalesce(F.nanvl(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(0.0)), F.lit(0.0))))


def with_tilts(sources: DataFrame, counts: DataFrame, cap: float, tolerance: float = 1e-9) -> DataFrame:
    """sources(source, total, target) with scale (its mean size), tilt and steps: lambda (by scale) from 0 by Newton's method on the dual, all sources at once.

    counts(source, size, n). tilt is infinite where the target is the cap itself, minus infinity where it is 0, 0 for a source of
    total 0. A step is Newton's if it stays inside the bracket of tilts known to give too little and too much, and
    the last one halved the gap; else the bracket's middle, or twice as far where it is still open. It ends where the tokens are
    within `tolerance` of the target, or the bracket has no number left inside.
    """
    total, target, tilt = F.col("total"), F.col("target"), F.col("tilt")
    fixed = F.when(total == 0, 0.0).when(target >= cap * total, math.inf).when(target <= 0, -math.inf)
    means = counts.filter("size > 0 AND n > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    start = _joined(sources.select("source", "total", "target"), means, "source", how="left")
    start = start.select("source", "total", "target", F.coalesce("scale", F.lit(1.0)).alias("scale"), F.coalesce(fixed, F.lit(0.0)).alias("tilt"), F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high"), F.lit(math.inf).alias("gap"), fixed.isNotNull().alias("done"), F.lit(0).alias("steps"))

    def ended(rows: DataFrame) -> tuple[DataFrame, int]:
        """The rows, and how many of them go on, from one job."""
        seen = Observation()
        return rows.observe(seen, F.count_if(~F.col("done")).alias("open")).checkpoint(), seen.get["open"]

    state, left = ended(start)
    result = ["source", "total", "target", "scale", "tilt", "steps"]
    out = state.filter("done").select(*result)
    while left:
        rows = _joined(counts, state.filter("NOT done"), "source").withColumn("rate", tilted_rate(cap))
        tokens = F.col("size") * F.col("n") * F.col("rate")
        slope = F.when(F.col("rate") < cap, tokens * F.col("size") / F.col("scale")).otherwise(0.0)
        moved = rows.groupBy("source", "total", "target", "scale", "tilt", "low", "high", "gap", "steps").agg(F.sum(tokens).alias("mass"), F.sum(slope).alias("slope"))
        missing = F.col("target") - F.col("mass")
        moved = moved.withColumn("low", F.when(missing > 0, F.greatest("low", tilt)).otherwise(F.col("low"))).withColumn("high", F.when(missing <= 0, F.least("high", tilt)).otherwise(F.col("high")))
        newton = F.when(F.col("slope") > 0, tilt + missing / F.col("slope"))
        closed = (F.col("low") > -math.inf) & (F.col("high") < math.inf)
        middle = F.when(closed, (F.col("low") + F.col("high")) / 2).otherwise(tilt + F.when(missing > 0, 1).otherwise(-1) * F.greatest(F.lit(1.0), F.abs(tilt)))
        good = F.coalesce((newton > F.col("low")) & (newton < F.col("high")), F.lit(False)) & (~closed | (2 * F.abs(missing) <= F.col("gap")))
        nothing_left = closed & ((middle <= F.col("low")) | (middle >= F.col("high")))
        reached = (F.abs(missing) <= tolerance * F.col("target")) | nothing_left
        new = F.when(reached, tilt).when(good, newton).otherwise(middle)
        moved = moved.select("source", "total", "target", "scale", new.alias("tilt"), "low", "high", F.abs(missing).alias("gap"), reached.alias("done"), (F.col("steps") + 1).alias("steps"))
        state, left = ended(moved)
        out = out.unionByName(state.filter("done").select(*result))
    return out


def mix(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """sized(doc_id, source, size long, ...) with source_size, target (its source's), rate, copies and taken (copies * size).

    Sources by code point, null last, weigh `weights`, repeating, and share the sum of
    all sizes; targets stop at `cap` times a source's size and the excess is shared
    anew. A document's rate is exp(lambda * size), one lambda a source, so within a source the long ones
    gain where it grows and lose where it shrinks. No document is taken more than `cap` times. Rows that repeat a doc_id, and rows
    without one, are documents of their own. Reruns agree: rounding follows size and a
    hash of doc_id (among rows that repeat a doc_id with the same source and size, which
    of them takes which copies may differ). Documents of size 0 may get copies and take nothing; a
    source of size 0 has target 0 and rate 1; an empty table gives an empty one. Columns of
    `sized` that have the name of a result are replaced, all others stay.
    """
    kept = sized.drop("source_size", "target", "rate", "copies", "taken")
    names = {n: f"{'_' * (1 + max(map(len, kept.columns)))}{n}" for n in ("part", "rank", "before", "inner", "change")}  # longer than any column
    part, rank, before, inner, change = names.values()
    n_parts = max(PARTS, math.ceil(kept.count() / PART_ROWS))
    rows = kept.withColumn(part, F.pmod(F.xxhash64("doc_id"), F.lit(n_parts)).cast("int"))
    counts = rows.groupBy("source", "size", part).agg(F.count("*").alias("n")).checkpoint()
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n")).checkpoint()
    totals = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("total"))
    tilted = with_tilts(with_targets(totals, weights, cap), by_size, cap)
    plan = tilted.select("source", F.col("total").alias("source_size"), "target", "scale", "tilt")

    up_to = lambda *key: Window.partitionBy(*key[:-1]).orderBy(key[-1]).rowsBetween(Window.unboundedPreceding, -1)
    rated = _joined(by_size, plan, "source").withColumn("rate", tilted_rate(cap))
    sizes = rated.select("source", "size", "source_size", "target", "rate", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(up_to("source", "size")), F.lit(0.0)).alias(before))
    parts = counts.select("source", "size", part, F.coalesce(F.sum("n").over(up_to("source", "size", part)), F.lit(0)).alias(inner))
    offsets = _joined(parts, sizes, "source", "size")
    ranked = rows.withColumn(rank, F.row_number().over(Window.partitionBy("source", "size", part).orderBy(F.xxhash64("doc_id"), "doc_id")))
    placed = _joined(ranked, offsets, "source", "size", part)
    upto = lambda k: F.floor(F.col(before) + (F.col(inner) + F.col(rank) - k) * F.col("rate") + 0.5)
    rounded = placed.withColumn("copies", F.least(upto(0) - upto(1), F.floor(F.lit(cap))).cast("long")).drop(before, inner).checkpoint()
    corrections = _corrections(rounded, cap, part, rank, change)
    out = _joined(rounded, corrections, "source", "size", part, rank, how="left")
    out = out.select(*kept.columns, "source_size", "target", "rate", (F.col("copies") + F.coalesce(F.col(change), F.lit(0))).alias("copies"))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def _corrections(rounded: DataFrame, cap: float, part: str, rank: str, change: str) -> DataFrame:
    """source, size, part, rank (which name a row) and change (1 or -1): at most four rows for each source and power of two."""
    flips = rounded.filter("size > 0").withColumn(change, F.explode(F.array(F.lit(1), F.lit(-1))))
    flips = flips.filter((F.col("copies") + F.col(change) >= 0) & (F.col("copies") + F.col(change) <= cap))
    key = F.struct(F.xxhash64("doc_id"), F.col("size"), F.col(part).alias("part"), F.col(rank).alias("rank"))
    found = flips.groupBy("source", change, F.floor(F.log2("size")).alias("scale")).agg(F.array(F.min(key), F.max(key)).alias("ends"))
    options = found.select("source", F.col(change).alias("change"), F.explode("ends").alias("end")).select("source", "change", "end.size", "end.part", "end.rank").distinct()
    short = rounded.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
    options = _joined(options, short, "source")

    def close(rows: pd.DataFrame) -> pd.DataFrame:
        gap, used, out = float(rows["gap"].iloc[0]), set(), []
        for sign in (1, -1) if gap > 0 else (-1, 1):
            some = rows[rows["sign"] == sign].sort_values(["tokens", "at", "place"], ascending=False)
            for name in zip(some["tokens"], some["at"], some["place"], strict=True):
                if name not in used and abs(gap - sign * name[0]) < abs(gap):
                    used.add(name)
                    out.append((rows["source"].iloc[0], *name, sign))
                    gap -= sign * name[0]
        return pd.DataFrame(out, columns=["source", "size", part, rank, change])

    plain = options.withColumnsRenamed({"change": "sign", "size": "tokens", "part": "at", "rank": "place"})
    return plain.groupBy("source").applyInPandas(close, f"source string, size long, `{part}` int, `{rank}` int, `{change}` long")
