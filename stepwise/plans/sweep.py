"""The catalog sweep from step files to verdicts in one query: read, split, parse, pair, count by the lattice, add up, compare."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import intervals, reconcile
from ..sources import corpus
from . import corpora

C = F.col
KEY = corpora.KEY
#: Parts of a beat that all beats are whole numbers of.
UNIT = 48


def swept_blocks(blocks, counts, key, unit=UNIT, width=4 * UNIT):
    """key, taps, hold_events, implied, verdict, delta, pct, shape of blocks(key, tags) as parse_tags gives them, against counts(key, count1, count2).

    Rows of a block that isn't a whole number of 1/unit beats off would be moved, so such a block has status `off_grid` and no counts.
    """
    notes = corpus.explode_notes(blocks, key).select(*key, (C("beat.num") * unit / C("beat.den")).cast("long").alias("t"), (C("beat.num") * unit % C("beat.den") != 0).alias("off"), "col", "sym").checkpoint()  # read for blocks off the grid and for the others' rows
    bad = notes.filter("off").select(*key).distinct().withColumn("error", F.lit("off_grid"))
    rows = notes.join(bad.select(*key), key, "left_anti").select(*key, "t", "col", "sym").checkpoint()  # read for holds, taps and heads
    holds = intervals.pair_holds(rows, [*key, "col"]).select(*key, "head", "tail")
    schedules = corpus.parse_schedules(blocks, ["TICKCOUNTS", "FAKES"], key).select(*key, "tag", "beat", "value").checkpoint()
    ticks = schedules.filter("tag = 'TICKCOUNTS'").select(*key, F.round(C("beat") * unit).cast("long").alias("beat"), F.round("value").cast("long").alias("value"), F.lit(0).alias("pos"))
    steps = intervals.rate_spans(ticks, key)
    fakes = schedules.filter("tag = 'FAKES'").select(*key, F.round(C("beat") * unit).cast("long").alias("s"), F.round((C("beat") + C("value")) * unit).cast("long").alias("e")).filter("e > s")
    taps = rows.filter("sym = '1'").select(*key, C("t").alias("beat"))
    counted = intervals.lattice_count(holds, steps, fakes, taps, key, unit, width)
    named = blocks.select(*key).join(bad, key, "left")
    implied = reconcile.implied_totals(taps, counted, named, key)
    alike = blocks.select(*key, F.count("*").over(Window.partitionBy(*key[:-1], F.sha2(F.element_at("tags", "NOTES"), 256))).alias("blocks_alike"))
    regions = counted.groupBy(*key).agg(F.count("*").alias("regions"))
    full = implied.join(counts, key, "left").join(alike, key).join(regions, key, "left").withColumn("regions", F.coalesce("regions", F.lit(0)))
    return reconcile.sweep(full).select(*key, "status", "taps", "hold_events", "implied", "verdict", "delta", "pct", "shape")


def corpus_sweep(spark, sf):
    """All blocks of the written step files against two counts for each, some of them missing."""
    blocks = corpus.parse_tags(corpora._blocks(spark, sf)).select(*KEY, "tags").checkpoint()  # read for notes, schedules and names
    lines = corpora._lines(spark, sf)
    counts = lines.select(*KEY, F.when(C("o") % 9 != 0, 1 + C("o") % 3 * 3).alias("count1"), F.when(C("o") % 4 != 0, 1 + C("p") % 4 * 3).alias("count2"))
    return swept_blocks(blocks, counts, KEY)


QUERIES = {"g2_corpus_sweep": corpus_sweep}

SQL = {
    "g2_corpus_sweep": f"""WITH {corpora._LINES}, r AS (SELECT song, block, 1 AS taps, CASE WHEN f = 'R' THEN 9 ELSE 0 END AS h, CASE WHEN o % 9 <> 0 THEN 1 + o % 3 * 3 END AS c1, CASE WHEN o % 4 <> 0 THEN 1 + p % 4 * 3 END AS c2, count(*) OVER (PARTITION BY song, n, a, c, f = 'R') AS alike FROM lines_),
        i AS (SELECT *, taps + h AS implied, coalesce(c1, c2) AS base FROM r),
        v AS (SELECT *, CASE WHEN base IS NULL THEN 'no_count' WHEN coalesce(implied = c1, false) OR coalesce(implied = c2, false) THEN 'exact' ELSE 'off' END AS verdict FROM i)
        SELECT song, block, 'ok' AS status, taps, h AS hold_events, implied, verdict, CASE WHEN verdict = 'off' THEN implied - base END AS delta, CASE WHEN verdict = 'off' THEN round(100 * (implied - base) / base, 1) END AS pct,
          CASE WHEN verdict <> 'off' THEN NULL WHEN alike > 1 THEN 'duplicate_block' WHEN h = 0 THEN 'hold_less' ELSE 'single_region' END AS shape FROM v""",
}
