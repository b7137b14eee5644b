"""Checks of a release against what it was made from, and the other halves of moved pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._range import overlap_join

#: What an entry name may hold besides letters and digits (a fixed value of the format).
KEPT = "$-_.+!*(),"
CHECKS = (
    "version_decimal", "version_stamp", "version_grows", "table_only", "entry_only", "steps_missing", "steps_extra", "steps_differ",
    "orphan_steps", "wrong_key", "repair_missing", "repair_ticks", "ticks_derived", "ticks_ledger", "dropped",
)


def entry_key(title: Column, artist: Column, description: Column, songtype: Column) -> Column:
    """The name that an entry's own metadata give it: joined by underscores, white space and slashes as underscores, other marks left out."""
    raw = F.concat_ws("_", F.concat_ws(" - ", title, artist), description, songtype)
    return F.regexp_replace(F.translate(raw, " /", "__"), rf"[^A-Za-z0-9{''.join('\\' + c for c in KEPT)}]", "")


def _step_path(column: str) -> Column:
    return F.element_at(F.split(F.translate(column, "\\", "/"), "simfiles/"), -1)


def release_checks(release: DataFrame, entries: DataFrame, table: DataFrame, shipped: DataFrame, tree: DataFrame, repairs: DataFrame, derived: DataFrame, ledger: DataFrame, old: DataFrame, samples: int = 5) -> DataFrame:
    """check, ok, n_bad, samples: one row for each of CHECKS, with the first names that fail it.

    release(name, version, stamp, previous): the version is a whole number, that of the file's name, and over the previous one (null: none).
    entries(key, title, artist, description, songtype, ssc_file, segments array<struct<s, e, n>>), table(name): the same names. shipped
    and tree(path, sha): the same files. An entry's key is the one that its metadata give, and its step file is shipped. repairs(chart,
    key, ticks): each is an entry (a `*` in its name doesn't count) with that many ticks. An entry's total has three routes: its own segments,
    what the converter derives (derived(key, segments): equal segment by segment, times to four places), and ledger(key, ticks). old(key): none is dropped.
    """
    total = F.aggregate("segments", F.lit(0).cast("long"), lambda n, x: n + F.bround(x["n"].cast("double"), 0).cast("long"))
    entry = entries.withColumn("ticks", F.coalesce(total, F.lit(0))).withColumn("path", _step_path("ssc_file"))
    only = lambda a, b, on, name: a.join(b.select(on), on, "left_anti").select(F.lit(name).alias("check"), F.col(on).cast("string").alias("name"))
    said = lambda rows, bad, name, who: rows.filter(F.coalesce(bad, F.lit(True))).select(F.lit(name).alias("check"), F.col(who).cast("string").alias("name"))
    digits = F.col("version").rlike(r"\A[0-9]+\z")
    number = lambda c: F.col(c).try_cast("long")
    grows = F.col("previous").isNull() | F.coalesce(number("version") > number("previous"), F.lit(False))
    plain = entry.select("key", "ticks", F.translate("key", "*", "").alias("_plain"))
    exact = repairs.join(plain.select("key", F.col("ticks").alias("_has"), F.lit(True).alias("_exact")), "key", "left")
    star = exact.join(plain.filter("key <> _plain").select(F.col("_plain").alias("key"), F.col("ticks").alias("_star"), F.lit(True).alias("_starred")), "key", "left")
    has = F.when(F.col("_exact"), F.col("_has")).otherwise(F.col("_star"))
    there = F.coalesce("_exact", F.lit(False)) | F.coalesce("_starred", F.lit(False))
    rounded = lambda c: F.transform(c, lambda x: F.struct(F.round(x["s"].cast("double"), 4).alias("s"), F.round(x["e"].cast("double"), 4).alias("e"), F.bround(x["n"].cast("double"), 0).cast("long").alias("n")))
    routes = entry.select("key", "ticks", rounded(F.coalesce("segments", F.array().cast(entries.schema["segments"].dataType))).alias("_own"))
    routes = routes.join(derived.select("key", rounded("segments").alias("_made")), "key", "left").join(ledger.select("key", F.col("ticks").alias("_known")), "key", "left")
    both = shipped.join(tree.select("path", F.col("sha").alias("_sha")), "path")
    names = entries.select(F.col("key").alias("name"))
    bad = [
        said(release, ~digits, "version_decimal", "name"), said(release, F.col("version") != F.col("stamp"), "version_stamp", "name"), said(release, ~grows, "version_grows", "name"),
        only(table, names, "name", "table_only"), only(names, table, "name", "entry_only"), only(tree, shipped, "path", "steps_missing"), only(shipped, tree, "path", "steps_extra"), said(both, F.col("sha") != F.col("_sha"), "steps_differ", "path"),
        entry.join(shipped.select("path"), "path", "left_anti").select(F.lit("orphan_steps").alias("check"), F.col("key").alias("name")),
        said(entry, entry_key(F.col("title"), F.col("artist"), F.col("description"), F.col("songtype")) != F.col("key"), "wrong_key", "key"),
        said(star, ~there, "repair_missing", "chart"), said(star.filter(there), has != F.col("ticks"), "repair_ticks", "chart"),
        said(routes, ~F.col("_own").eqNullSafe(F.col("_made")), "ticks_derived", "key"), said(routes.filter("_known IS NOT NULL"), F.col("_known") != F.col("ticks"), "ticks_ledger", "key"),
        only(old, entries, "key", "dropped"),
    ]
    rows = bad[0]
    for more in bad[1:]:
        rows = rows.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("check").orderBy("name"))
    counted = rows.groupBy("check", "name").agg(F.count("*").alias("n"))
    few = counted.withColumn("_k", rank).groupBy("check").agg(F.sum("n").alias("n_bad"), F.array_sort(F.collect_list(F.when(F.col("_k") <= samples, F.col("name")))).alias("samples"))
    every = release.sparkSession.createDataFrame([(c,) for c in CHECKS], "check string")
    out = every.join(few, "check", "left").withColumn("n_bad", F.coalesce("n_bad", F.lit(0)))
    return out.select("check", (F.col("n_bad") == 0).alias("ok"), "n_bad", F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def partner_sides(moves: DataFrame, charts: DataFrame) -> DataFrame:
    """chart, source, side: the other halves of split pictures that moves bring a chart onto, whose side is not set or another.

    moves(chart, best_source, best_side), charts(chart, best_source, best_side, source, side): what is best for each chart and what it uses now. A partner isn't
    moved itself, already uses the picture that is best for it, and has a side there; so has the move.
    """
    onto = moves.filter("best_side IS NOT NULL AND best_side <> ''").select("best_source").distinct()
    stays = charts.join(moves.select("chart"), "chart", "left_anti").join(onto, "best_source", "left_semi")
    half = stays.filter("best_side IS NOT NULL AND best_side <> '' AND source = best_source AND coalesce(side, '') <> best_side")
    return half.select("chart", "source", F.col("best_side").alias("side")).distinct()


def pin_regions(regions: DataFrame, pins: DataFrame, by: Sequence[str], width: float, slack: float = 0.15) -> DataFrame:
    """by, pin, region, value, matches: each measured span on the region that it meets, null where it meets none or several: no guess is pinned.

    regions(by, region, rs, re), pins(by, pin, s, e, value). Spans meet if they overlap, or lie less than `slack` apart.
    """
    wide = pins.withColumn("_a", F.col("s") - slack).withColumn("_b", F.col("e") + slack)
    hits = overlap_join(wide.select(*by, "pin", "_a", "_b"), regions.select(*by, "region", "rs", "re"), by, ("_a", "_b"), ("rs", "re"), width)
    found = hits.groupBy(*by, "pin").agg(F.count("*").alias("matches"), F.min("region").alias("_r"))
    rows = pins.join(found, [*by, "pin"], "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    return rows.select(*by, "pin", F.when(F.col("matches") == 1, F.col("_r")).alias("region"), "value", "matches")


def pinned_totals(assigned: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, region, value, pins: what several measured spans of one region come to together."""
    return assigned.filter("region IS NOT NULL").groupBy(*by, "region").agg(F.sum("value").alias("value"), F.count("*").alias("pins"))
