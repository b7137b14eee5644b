"""Queries of the release checks (H14), partner rows (H15) and regions pinned by exactly one span (C7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import release as op
from .adapters import EVENTS, HOUR, MINUTE, SPANS, events, spans, table

C, L = F.col, F.lit
BY = ["series"]


def release_checks(spark, sf):
    """Parts as entries, their suppliers' step files shipped, with defects planted by number."""
    k = C("p_partkey")
    part = table(spark, sf, "part")
    title = F.concat(L("Song"), k)
    name = F.concat(title, L("_-_"), F.regexp_replace("p_brand", "#", ""), L("_S"), "p_size", L("_ARCADE"))
    segments = F.array(F.struct(L(0.0).alias("s"), (k % 7 + 0.12344).alias("e"), (k % 5).alias("n")), F.struct(L(9.0).alias("s"), L(10.0).alias("e"), C("p_size").cast("long").alias("n")))
    ticks = k % 5 + C("p_size")
    folder = F.concat(L("C:\\x\\simfiles\\"), k % 40, L("\\"), k % 10, L(".ssc"))
    entries = part.filter(k % 50 != 1).select(F.when(k % 31 == 0, "odd").otherwise(name).alias("key"), title.alias("title"), F.translate("p_brand", "#", "").alias("artist"), F.concat(L("S"), "p_size").alias("description"), L("ARCADE").alias("songtype"), folder.alias("ssc_file"), segments.alias("segments"), "p_partkey")
    listed = part.filter(k % 60 != 2).select(name.alias("name"))
    path = F.concat(k % 40, L("/"), k % 10, L(".ssc"))
    tree = part.select(path.alias("path"), F.sha1((k % 40).cast("string")).alias("sha")).distinct()
    shipped = tree.filter("path NOT LIKE '7/%'").withColumn("sha", F.when(C("path").like("3/%"), "x").otherwise(C("sha"))).union(spark.range(1).select(L("extra.ssc"), L("y")))
    repairs = part.filter(k % 20 == 0).select(k.alias("chart"), F.when(k % 100 == 0, "gone").otherwise(name).alias("key"), (ticks + F.when(k % 40 == 0, 1).otherwise(0)).alias("ticks"))
    made = entries.select("key", F.when(C("p_partkey") % 33 == 0, F.slice("segments", 1, 1)).otherwise(C("segments")).alias("segments"))
    known = part.filter(k % 3 == 0).select(name.alias("key"), (ticks + F.when(k % 27 == 0, 2).otherwise(0)).alias("ticks"))
    old = part.filter(k % 25 == 1).select(name.alias("key"))
    head = spark.range(1).select(L("release").alias("name"), L("260911").alias("version"), L("260910").alias("stamp"), L("260908").alias("previous"))
    out = op.release_checks(head, entries.filter("key <> 'odd'").drop("p_partkey").unionByName(entries.filter("p_partkey = 31").drop("p_partkey")), listed, shipped, tree, repairs, made.filter("key <> 'odd'"), known, old)
    return out.select("check", "ok", "n_bad", F.array_join("samples", ",").alias("samples"))


def partner_sides(spark, sf):
    """Orders as charts on their customers' pictures."""
    k = C("o_orderkey")
    side = F.when(k % 5 == 0, None).otherwise(F.when(k % 2 == 0, "Left").otherwise("Right"))
    charts = table(spark, sf, "orders").select(k.alias("chart"), C("o_custkey").alias("best_source"), side.alias("best_side"), F.when(k % 3 == 0, C("o_custkey")).otherwise(0).alias("source"), F.when(k % 7 == 0, None).when(k % 4 == 0, "Left").otherwise("Right").alias("side"))
    return op.partner_sides(charts.filter("source = 0 AND chart % 11 < 2").select("chart", "best_source", "best_side"), charts)


def _pins(spark, sf):
    pins = events(spark, sf, "error").select("series", C("id").alias("pin"), C("t").alias("s"), (C("t") + C("k") * 10 * MINUTE).alias("e"), C("v").alias("value"))
    regions = spans(spark, sf, "view", 3).select("series", C("id").alias("region"), C("s").alias("rs"), C("e").alias("re"))
    return op.pin_regions(regions, pins, BY, 12 * HOUR, HOUR)


def pin_regions(spark, sf):
    """Errors as measured spans on the view spans that they meet within an hour, if it is exactly one."""
    return _pins(spark, sf)


def pinned_totals(spark, sf):
    return op.pinned_totals(_pins(spark, sf), BY)


QUERIES = {"h14_release_checks": release_checks, "h15_partner_sides": partner_sides, "c7_pin_regions": pin_regions, "c7_pinned_totals": pinned_totals}

_PINS = f"{EVENTS}, {SPANS('views', 'view', 3)}, p AS (SELECT series, id AS pin, t AS s, t + k * {10 * MINUTE} AS e, v FROM events_ WHERE kind = 'error'), h AS (SELECT p.series, pin, count(*) AS n, min(w.id) AS r FROM p JOIN views w ON p.series = w.series AND p.s - {HOUR} < w.e AND w.s < p.e + {HOUR} GROUP BY ALL), a AS (SELECT p.series, p.pin, CASE WHEN n = 1 THEN r END AS region, v AS value, coalesce(n, 0) AS matches FROM p LEFT JOIN h ON p.series = h.series AND p.pin = h.pin)"
SQL = {
    "h15_partner_sides": """WITH c AS (SELECT o_orderkey AS chart, o_custkey AS bs, CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Left' ELSE 'Right' END END AS side_, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE 0 END AS source, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'Left' ELSE 'Right' END AS side FROM orders), m AS (SELECT * FROM c WHERE source = 0 AND chart % 11 < 2)
        SELECT chart, source, side_ AS side FROM c WHERE bs IN (SELECT bs FROM m WHERE side_ IS NOT NULL) AND chart NOT IN (SELECT chart FROM m) AND source = bs AND side_ IS NOT NULL AND coalesce(side, '') <> side_""",
    "c7_pin_regions": f"WITH {_PINS} SELECT * FROM a",
    "c7_pinned_totals": f"WITH {_PINS} SELECT series, region, CAST(sum(value) AS BIGINT) AS value, count(*) AS pins FROM a WHERE region IS NOT NULL GROUP BY 1, 2",
}
