"""From decoded frame signals to events: onsets, occupancy, tracks, notes and holds."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ._range import asof, nearest
from .series import key_schema, per_batch, per_series


def less_percentile(rows: DataFrame, value: str, q: float, frame: WindowSpec, name: str) -> DataFrame:
    """rows with name: value less the q-th percentile of its window frame.

    Between two values the percentile is lower * (1 - part) + upper * part with the first product fused into the sum, as DuckDB
    has it; Spark rounds that product, so that rises which are equal there differ here in their last bit.
    """
    sort, at = F.col("_sorted"), (F.size("_sorted") - 1) * F.lit(float(q))
    part = at - F.floor(at)
    low, high = (F.get(sort, f(at).cast("int")).cast("double") for f in (F.floor, F.ceil))
    between = F.reflect(F.lit("java.lang.Math"), F.lit("fma"), low, 1 - part, high * part).cast("double")
    rows = rows.withColumn("_sorted", F.sort_array(F.collect_list(value).over(frame)))
    return rows.withColumn(name, F.col(value) - F.when((F.size("_sorted") > 0) & (part > 0), between).otherwise(low)).drop("_sorted")


def rises(signal: DataFrame, by: Sequence[str], value: str = "v", thresh: float = 0, back: int = 30, around: int = 4, q: float = 0.3) -> DataFrame:
    """signal rows with rise (value less the q-th percentile of the last 31 frames) that are the greatest of +-4 frames and over thresh; the first and last 4 frames are ignored."""
    order = Window.partitionBy(*by).orderBy("frame")
    rows = less_percentile(signal, value, q, order.rowsBetween(-back, 0), "rise")
    rows = rows.withColumn("_top", F.max("rise").over(order.rowsBetween(-around, around))).withColumn("_i", F.row_number().over(order)).withColumn("_n", F.count("*").over(Window.partitionBy(*by)))
    return rows.filter((F.col("rise") == F.col("_top")) & (F.col("rise") > thresh) & (F.col("_i") > around) & (F.col("_i") <= F.col("_n") - around)).drop("_top", "_i", "_n")


def keep_apart(peaks: DataFrame, by: Sequence[str], apart: float) -> DataFrame:
    """by, t, rise: peaks taken in order, each at least `apart` after the last one taken."""

    def choose(d: pd.DataFrame) -> pd.DataFrame:
        keep, last = [], -np.inf
        for i, t in enumerate(d["t"].tolist()):
            if t - last >= apart:
                keep.append(i)
                last = t
        return d.iloc[keep][["t", "rise"]]

    kind = peaks.schema["t"].dataType.simpleString()
    return per_series(peaks.select(*by, "t", "rise"), by, choose, f"t {kind}, rise double")


def onsets(signal: DataFrame, by: Sequence[str], value: str = "v", thresh: float = 0, apart: float = 0.07) -> DataFrame:
    """by, t, rise: the rises that lie apart."""
    return keep_apart(rises(signal, by, value, thresh), by, apart)


def occupancy_spans(signal: DataFrame, by: Sequence[str], value: str, thresh: float, least: int, bridge: int = 3) -> DataFrame:
    """by, f0, f1, frames: runs of frames at or over thresh, over up to `bridge` frames off, at least `least` long."""
    order = Window.partitionBy(*by).orderBy("frame")
    on = signal.filter(F.col(value) >= thresh)
    rows = on.withColumn("_new", F.when(F.col("frame") - F.lag("frame").over(order) <= bridge + 1, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    return rows.groupBy(*by, "_run").agg(F.min("frame").alias("f0"), F.max("frame").alias("f1"), F.count("*").alias("frames")).filter(F.col("f1") - F.col("f0") + 1 >= least).drop("_run")


def learned_floor(detections: DataFrame, by: Sequence[str], correlation: float, strong: float = 0.6, share: float = 0.35, least: int = 40) -> DataFrame:
    """detections(by, q, sat) of at least that correlation q and of their series' floor of saturation, with floor: share of the 10th percentile of sat of those with q >= strong, 0 under `least` of them."""
    sure = F.when(F.col("q") >= strong, F.col("sat"))
    floors = detections.groupBy(*by).agg(F.percentile(sure, F.lit(0.1)).alias("_p"), F.count(sure).alias("_n"))
    floors = floors.select(*by, F.when(F.col("_n") >= least, F.col("_p") * share).otherwise(0.0).alias("floor"))
    return detections.join(floors, list(by)).filter((F.col("q") >= correlation) & (F.col("sat") >= F.col("floor")))


def track(detections: DataFrame, by: Sequence[str], reach: float = 26, keep: float = 0.6, misses: int = 2) -> DataFrame:
    """by, track, frame, t, y: greedy links of detections(by, frame, t, y) to the nearest predicted position less than reach away.

    Frame by frame, tracks by age. A track is expected one step of its velocity after its last position, however
    many frames it missed; its velocity is the first step, then keep * old + (1 - keep) * the last step. A track that
    misses more than `misses` frames ends; frames without detections count.
    """

    def link(frames: list, ys: list) -> list[int]:
        live: list[dict] = []
        name, out, at = 0, [0] * len(ys), 0
        while at < len(ys) and pd.notna(frames[at]):
            frame, free = frames[at], {}
            while at < len(ys) and frames[at] == frame:
                free[at] = ys[at]
                at += 1
            live = [k for k in live if frame - k["frame"] <= misses + 1]
            for k in live:
                want = k["y"] + k["v"]
                near = min(free, key=lambda i: (abs(free[i] - want), i), default=None)
                if near is not None and abs(free[near] - want) < reach:
                    y = free.pop(near)
                    step = y - k["y"]
                    k["v"] = keep * k["v"] + (1 - keep) * step if k["n"] > 1 else step
                    k |= {"y": y, "frame": frame, "n": k["n"] + 1}
                    out[near] = k["name"]
            for i, y in free.items():
                live.append({"name": name, "y": y, "v": 0.0, "frame": frame, "n": 1})
                out[i] = name
                name += 1
        return out

    def linked(d: pd.DataFrame, at: np.ndarray) -> pd.DataFrame:
        frames, ys = d["frame"].tolist(), d["y"].astype(float).tolist()
        return d.assign(track=[k for a, b in pairwise(at.tolist()) for k in link(frames[a:b], ys[a:b])])[[*by, "track", "frame", "t", "y"]]

    rows = detections.select(*by, "frame", "t", "y")
    return per_batch(rows, by, (F.asc_nulls_last("frame"), F.asc_nulls_last("y")), linked, f"{key_schema(rows, by)}, track long, {key_schema(rows, ['frame', 't', 'y'])}")


def fit_tracks(tracks: DataFrame, by: Sequence[str], y: float, least: int = 4, slowest: float = -60) -> DataFrame:
    """by, n, v, t, first, last: least-squares lines of tracks(by, t, y) with enough points and a speed of at most `slowest`, and when they cross y."""
    rows = tracks.groupBy(*by).agg(F.count("*").alias("n"), F.regr_slope("y", "t").alias("v"), F.avg("t").alias("_t"), F.avg("y").alias("_y"), F.min("t").alias("first"), F.max("t").alias("last"))
    return rows.filter((F.col("n") >= least) & (F.col("v") <= slowest)).select(*by, "n", "v", (F.col("_t") + (y - F.col("_y")) / F.col("v")).alias("t"), "first", "last")


def merge_close(notes: DataFrame, by: Sequence[str], near: float = 0.015) -> DataFrame:
    """notes(by, t, frames, ...): of notes less than `near` after the one before them, the one with most frames (ties: the first)."""
    order = Window.partitionBy(*by).orderBy("t")
    rows = notes.withColumn("_new", F.when(F.col("t") - F.lag("t").over(order) < near, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    best = Window.partitionBy(*by, "_run").orderBy(F.desc("frames"), "t")
    return rows.withColumn("_k", F.row_number().over(best)).filter("_k = 1").select(*notes.columns)


def drop_odd_speed(notes: DataFrame, series: Sequence[str], off: float = 0.4, around: int = 25) -> DataFrame:
    """Notes whose speed v is within `off` of the median of the 25 before and 24 after."""
    order = Window.partitionBy(*series).orderBy("t", "v").rowsBetween(-around, around - 1)
    middle = F.percentile("v", F.lit(0.5)).over(order)
    return notes.withColumn("_m", middle).filter(F.abs(F.col("v") / F.col("_m") - 1) <= off).drop("_m")


def drop_short_streaks(notes: DataFrame, series: Sequence[str], frames: int = 4, slow: float = 0.12, near: float = 0.06, around: int = 25) -> DataFrame:
    """Notes but those of few frames, slower than the local median by `slow`, within `near` of a longer one (in any column)."""
    order = Window.partitionBy(*series).orderBy("t", "v").rowsBetween(-around, around - 1)
    rows = notes.withColumn("_m", F.percentile(F.abs("v"), F.lit(0.5)).over(order))
    short = F.col("frames") <= frames
    long_ones = rows.filter(~short).select(*series, "t")
    got = nearest(rows, long_ones.distinct(), series, "t", "_near", near)
    return got.filter(~(short & (F.abs("v") < (1 - slow) * F.col("_m")) & F.col("_near").isNotNull())).select(*notes.columns)


def mark_holds(notes: DataFrame, rails: DataFrame, by: Sequence[str], least: float = 0.05, most: float = 0.15, share: float = 0.6) -> DataFrame:
    """notes(by, t) with hold_end: each rail(by, s, e) is claimed by the nearest note within min(most, max(least, share * length)) of its head (ties: the earlier note; a note takes the longest of its rails); notes inside a claimed rail go."""
    window = F.least(F.lit(most), F.greatest(F.lit(least), share * (F.col("e") - F.col("s"))))
    near = nearest(rails.withColumn("t", F.col("s")), notes.select(*by, "t").distinct(), by, "t", "_note")
    claimed = near.filter(F.abs(F.col("_note") - F.col("s")) <= window).groupBy(*by, F.col("_note").alias("t")).agg(F.max("e").alias("hold_end"))
    rows = notes.join(claimed, [*by, "t"], "left")
    spans = claimed.select(*by, "t", F.col("t").alias("_s"), F.col("hold_end").alias("_e"))
    inside = asof(rows, spans, by, "t", ["_e"], strict=True)
    return inside.filter(F.col("_e").isNull() | (F.col("t") > F.col("_e")) | F.col("hold_end").isNotNull()).drop("_e")


def quantise(notes: DataFrame, by: Sequence[str], origin: float, per_beat: float, grid: int, most: float = 0.70) -> DataFrame:
    """by, line, error, t: notes(by, t) on the lines of a grid; of several on one line the best fit (ties: the earlier); a fit of `most` or worse goes."""
    x = (F.col("t") - origin) / per_beat * grid
    rows = notes.withColumn("line", F.round(x).cast("long")).withColumn("error", F.abs(x - F.round(x)) * 2).filter(F.col("error") < most)
    best = Window.partitionBy(*by, "line").orderBy(F.round("error", 9), "t")
    return rows.withColumn("_k", F.row_number().over(best)).filter("_k = 1").select(*by, "line", "error", "t")


def min_gap_filter(notes: DataFrame, by: Sequence[str], gap: float, order_by: Sequence[str] = ("t",)) -> DataFrame:
    """Notes that don't follow the one before them (in order_by) in their column by less than gap."""
    order = Window.partitionBy(*by).orderBy(*order_by)
    return notes.withColumn("_g", F.col("t") - F.lag("t").over(order)).filter(F.col("_g").isNull() | (F.col("_g") >= gap)).drop("_g")


def shift_releases(notes: DataFrame, by: float) -> DataFrame:
    """notes with every hold_end moved by `by`, but not before the note."""
    return notes.withColumn("hold_end", F.when(F.col("hold_end").isNotNull(), F.greatest(F.col("t"), F.col("hold_end") + by)))


def cap_tails(holds: DataFrame, spans: DataFrame, by: Sequence[str]) -> DataFrame:
    """holds(by, t, hold_end) with the tail cut to the end of the last occupancy span(by, s, e) that starts at or before it."""
    got = asof(holds.withColumn("_t", F.col("t")).withColumn("t", F.col("hold_end")), spans.select(*by, F.col("s").alias("t"), F.col("e").alias("_e")), by, "t", ["_e"])
    return got.withColumn("hold_end", F.when(F.col("_e") >= F.col("_t"), F.least("hold_end", "_e")).otherwise(F.col("hold_end"))).withColumn("t", F.col("_t")).drop("_t", "_e")
