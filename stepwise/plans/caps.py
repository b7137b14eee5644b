"""Queries of claimed holds (J7), short caps and off-speed notes (J9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import caps as op
from .adapters import HOUR, events

C = F.col
BY = ["series"]
#: gap, head, cap, speed, opens, bar and closes of short caps, in hours.
CAPS = ((0.5, 60.0), (0.2, 1.9), 1.6, 0.9, 12.0, (0.5, 40.0), 30.0)


def note_inputs(spark, sf):
    """Clicks as notes, views as rails and bars, all events as frames of a lane; in hours, four columns."""
    t = (C("t") - 1_704_067_200_000_000) / HOUR
    col = (C("k") % 2).alias("col")
    notes = events(spark, sf).filter("kind IN ('click', 'purchase')").select("series", col, "id", t.alias("t"), (-40.0 - C("k") % 30).alias("v"), F.when(C("k") % 9 != 0, C("k") / 100).alias("q"), (C("k") % 8).alias("frames"), (t - 1).alias("mt"), (C("v") * 1.0).alias("my"), F.lit(20.0).alias("yj"))
    rails = events(spark, sf, "view").select("series", col, C("id").alias("rail"), t.alias("a"), (t + C("k") % 20 + 0.5).alias("b"))
    lane = events(spark, sf).groupBy("series", col, t.alias("t")).agg(F.max(C("k") / 100).alias("occ"))
    return notes, rails, lane


def claim_holds(spark, sf):
    notes, rails, lane = note_inputs(spark, sf)
    out = op.claim_holds(notes, rails, lane, op.rail_lag(notes, BY, 60.0), BY, 24.0, 9.0, 2.0, 0.6, (0.5, 2.0))
    return out.select("series", "col", "id", *(F.round(c, 6).alias(c) for c in ("hold_end", "rail_len", "rail_occ")))


def short_caps(spark, sf):
    notes, rails, _ = note_inputs(spark, sf)
    held = notes.withColumn("hold_end", F.when(C("id") % 5 == 0, C("t") + 1))
    return op.drop_short_caps(held, rails.drop("rail"), op.rail_lag(notes, BY, 60.0), BY, 24.0, *CAPS).select("series", "col", "id")


def retime(spark, sf):
    out = op.retime(note_inputs(spark, sf)[0], BY, 0.2, 4)
    return out.select("series", "id", F.round("t", 6).alias("t"), "retimed")


QUERIES = {"j7_claim_holds": claim_holds, "j9_short_caps": short_caps, "j9_retime": retime}

SQL = {}
