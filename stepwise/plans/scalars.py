"""Queries A10 and B1 to B13."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as fn
from .adapters import EVENTS, events, table


def norm_title(spark, sf):
    return table(spark, sf, "part").select("p_partkey", fn.norm_title(F.concat_ws(" - ", "p_name", "p_brand")).alias("title"))


def parse_upload_title(spark, sf):
    """Part names as titles '[PUMP IT UP era] name - FULL SONG - S<size> & D<size> (pre S1) | type', some without a tag or of an era that isn't known."""
    era = F.element_at(F.array(*map(F.lit, ("PHOENIX", "FIESTA 2", "RISE", "XX", ""))), (F.col("p_size") % 5 + 1).cast("int"))
    tag = F.when(era == "", "").otherwise(F.concat(F.lit("[PUMP IT UP "), era, F.lit("] ")))
    rows = table(spark, sf, "part").select("p_partkey", F.concat(tag, "p_name", F.lit("(슬램)"), F.when(F.col("p_size") % 3 == 0, " - FULL SONG - ").otherwise(" "), F.when(F.col("p_size") % 11 == 0, "").otherwise(F.concat(F.lit("S"), "p_size", F.lit(" & DP0"), F.col("p_size") % 9)), F.lit(" (pre S1 → S2) | S3 "), "p_type").alias("title"))
    parsed = rows.select("p_partkey", fn.parse_upload_title(F.col("title")).alias("t"))
    return parsed.select("p_partkey", "t.era", "t.name", F.array_join("t.codes", ",").alias("codes"), "t.song_type")


def key_to_tag(spark, sf):
    end = F.element_at(F.array(*map(F.lit, ("_ARCADE", "_INFOBAR_TITLE_ARCADE", "", "_TRAIN_FULLSONG"))), (F.col("p_size") % 4 + 1).cast("int"))
    rows = table(spark, sf, "part").select("p_partkey", F.concat(F.regexp_replace("p_name", " ", "_"), F.lit("_-_X"), F.when(F.col("p_size") % 5 == 0, "").otherwise(F.concat(F.lit("_D"), F.col("p_size") % 30)), end).alias("key"))
    tag = fn.key_to_tag(F.col("key"))
    return rows.select("p_partkey", tag.alias("tag"), fn.tag_to_key(F.regexp_extract("key", "^(.*_-_X)", 1), tag).alias("again"))


def family_of(spark, sf):
    name = F.concat_ws(" ", "p_name", F.lit("(live)"), F.lit("- FULL SONG -"), "p_size", F.concat(F.lit("S"), "p_size"))
    return table(spark, sf, "part").select("p_partkey", fn.family_of(name).alias("tokens"), fn.family_of(name, "sequel").alias("sequel"), fn.family_of(name, "strip").alias("strip"))


def is_official(spark, sf):
    """Parts as blocks: style, song type, meter and label from their columns."""
    pick = lambda c, *x: F.element_at(F.array(*map(F.lit, x)), (F.col(c) % len(x) + 1).cast("int"))
    rows = table(spark, sf, "part").withColumn("style", pick("p_size", "pump-single", "pump-double", "pump-couple", "pump-halfdouble")).withColumn("kind", pick("p_partkey", "ARCADE", "REMIX", None, "JINGLE"))
    label = pick("p_partkey", "S17", "D20 PRO", "PROMISE", "COOP x2", None, "S5 QUEST", "JUMP D1")
    return rows.select("p_partkey", fn.is_official(F.col("style"), F.col("kind"), F.when(F.col("p_size") == 7, 99).otherwise(F.col("p_size")), label).alias("official"))


def to_rational(spark, sf):
    """Values as multiples of a fraction whose nearest simple form is known."""
    rows = events(spark, sf).select("id", (F.col("v") % 50).alias("whole"), (F.col("k") % 7 + 2).alias("den"), (F.col("id") % 2).alias("num"))
    return rows.select("id", fn.to_rational(F.col("whole") + F.col("num") / F.col("den"), 192).alias("r")).select("id", "r.num", "r.den")


def norm_answer(spark, sf):
    answer = F.concat("p_name", F.lit(" ; ;"), "p_type", F.lit("|, "), "p_brand", F.lit("\n"))
    return table(spark, sf, "part").select("p_partkey", fn.norm_answer(answer).alias("answer"))


def exclusions(spark, sf):
    """Customers excluded by name or segment: a list from the suppliers and two segments."""
    base = table(spark, sf, "supplier").filter("s_suppkey % 3 = 0").select(F.concat(F.lit("Customer#"), F.substring("s_name", -9, 9)).alias("item"), F.lit("same number as a supplier").alias("reason"))
    lists = base.union(table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'").select("c_mktsegment", F.lit("segment")).distinct())
    return fn.exclusions(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), lists, "c_name", "c_mktsegment")


def snap_to_grid(spark, sf):
    rows = events(spark, sf).select("id", (F.col("v") * 100 + F.col("k")).alias("u"))
    beat = F.col("u") / 240
    off = F.round(fn.grid_error(beat, 4), 6)
    return rows.select("id", F.round(fn.snap_to_grid(beat, (1, 2, 3, 4, 6, 8), 0.01), 6).alias("beat"), fn.choose_grid(beat).alias("grid"), off.alias("error"))


def digit_alternatives(spark, sf):
    rows = events(spark, sf).select("id", "v", F.explode(fn.digit_alternatives(F.col("v"), 400)).alias("alternative"))
    return rows


def screen_checks(spark, sf):
    """Line items as result screens, some cells not numbers."""
    rows = table(spark, sf, "lineitem")
    great, combo = F.col("l_partkey") % 10, F.when(F.col("l_suppkey") % 9 == 0, F.lit("?")).otherwise((F.col("l_quantity") + F.col("l_linenumber") - 2).cast("long").cast("string"))
    bad = F.when(F.col("l_orderkey") % 4 == 0, 1).otherwise(0)
    checks = fn.screen_checks(F.col("l_quantity").cast("long"), great, F.lit(0), bad, F.lit(0), combo)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(checks, "+").alias("checks")).groupBy("checks").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.sum("l_partkey").alias("parts"))


def noise_filter(spark, sf):
    return fn.noise_filter(events(spark, sf), 0.25, 4, 300).select("series", "id", "v", "conf")


def judged_symbol(spark, sf):
    """Events as note cells."""
    cell = F.element_at(F.array(*map(F.lit, ("1", "M", "4", "{2|n|0|0}", "{1|n|1|0}", "F", "L", "X"))), (F.col("k") % 8 + 1).cast("int"))
    return events(spark, sf).select("id", fn.judged_symbol(cell).alias("symbol"), fn.drawn_fake(cell).alias("fake"))


def pick_band(spark, sf):
    bands = F.element_at(F.array(*map(F.lit, "CLR")), (F.col("id") % 3 + 1).cast("int"))
    rows = events(spark, sf).select(F.col("series").alias("vid"), "id", bands.alias("band"), F.when((F.col("series") % 2 == 0) & (bands == "C"), None).otherwise(F.col("v")).alias("v"))
    return fn.pick_band(rows)


QUERIES = {
    "b1_norm_title": norm_title, "b2_parse_upload_title": parse_upload_title, "b3_key_to_tag": key_to_tag, "b4_family_of": family_of, "b5_norm_answer": norm_answer, "b6_is_official": is_official, "b9_to_rational": to_rational, "b7_exclusions": exclusions,
    "b8_snap_to_grid": snap_to_grid, "b10_digit_alternatives": digit_alternatives, "b11_screen_checks": screen_checks, "b12_noise_filter": noise_filter, "b13_judged_symbol": judged_symbol, "a10_pick_band": pick_band,
}

SQL = {
    "b1_norm_title": "SELECT p_partkey, regexp_replace(lower(p_name || ' - ' || p_brand), '[^a-z0-9]', '', 'g') AS title FROM part",
    "b2_parse_upload_title": "WITH e AS (SELECT *, ['PHOENIX', 'FIESTA 2', 'RISE', 'XX', ''][p_size % 5 + 1] AS tag FROM part), t AS (SELECT *, tag NOT IN ('RISE', '') AS ok, p_size % 11 <> 0 AS coded FROM e) SELECT p_partkey, CASE WHEN ok THEN tag END AS era, CASE WHEN ok AND coded THEN regexp_replace(p_name, '[^a-z0-9]', '', 'g') END AS name, CASE WHEN ok THEN CASE WHEN coded THEN 'S' || p_size || ',D' || (p_size % 9) ELSE '' END END AS codes, CASE WHEN ok AND p_size % 3 = 0 THEN 'FullSong' END AS song_type FROM t",
    "b3_key_to_tag": "WITH t AS (SELECT p_partkey, replace(p_name, ' ', '_') || '_-_X' AS song, CASE WHEN p_size % 5 <> 0 THEN 'D' || (p_size % 30) || [' ', ' INFOBAR TITLE', NULL, ' TRAIN'][p_size % 4 + 1] END AS label, CASE p_size % 4 WHEN 3 THEN 'FULLSONG' ELSE 'ARCADE' END AS kind FROM part) SELECT p_partkey, trim(label) || '_' || kind AS tag, song || '_' || replace(trim(label), ' ', '_') || '_' || kind AS again FROM t",
    "b4_family_of": "SELECT p_partkey, array_to_string(list_slice(regexp_extract_all(p_name || ' live ' || p_size, '[a-z0-9]+'), 1, 2), ' ') AS tokens, replace(p_name, ' ', '') AS sequel, p_name || ' (live) ' || p_size AS strip FROM part",
    "b6_is_official": "SELECT p_partkey, p_size % 4 <> 2 AND p_partkey % 4 <> 3 AND p_size <> 7 AND p_partkey % 7 IN (0, 2, 4) AS official FROM part",
    "b9_to_rational": f"WITH {EVENTS}, x AS (SELECT id, v % 50 AS w, k % 7 + 2 AS d, id % 2 AS n FROM events_) SELECT id, CASE WHEN n = 0 THEN w ELSE w * d + 1 END AS num, CASE WHEN n = 0 THEN 1 ELSE d END AS den FROM x",
    "b5_norm_answer": "SELECT p_partkey, upper(replace(p_name, ' ', '') || '/' || p_type || '/' || p_brand) AS answer FROM part",
    "b7_exclusions": "SELECT c_custkey, c_name, c_mktsegment, CASE WHEN s_suppkey IS NOT NULL THEN 'same number as a supplier' WHEN c_mktsegment = 'MACHINERY' THEN 'segment' END AS reason FROM customer LEFT JOIN supplier ON right(s_name, 9) = right(c_name, 9) AND s_suppkey % 3 = 0",
    "b8_snap_to_grid": f"WITH {EVENTS}, b AS (SELECT id, (v * 100 + k) / 240 AS b FROM events_) SELECT id, round(CASE WHEN abs(round(b) - b) <= 0.01 THEN round(b) WHEN abs(round(b * 2) / 2 - b) <= 0.01 THEN round(b * 2) / 2 WHEN abs(round(b * 3) / 3 - b) <= 0.01 THEN round(b * 3) / 3 WHEN abs(round(b * 4) / 4 - b) <= 0.01 THEN round(b * 4) / 4 WHEN abs(round(b * 6) / 6 - b) <= 0.01 THEN round(b * 6) / 6 WHEN abs(round(b * 8) / 8 - b) <= 0.01 THEN round(b * 8) / 8 ELSE round(b * 48) / 48 END, 6) AS beat, CASE WHEN abs(round(b * 12) / 12 - b) < abs(round(b * 16) / 16 - b) - 0.01 THEN 12 ELSE 16 END AS grid, round(abs(b * 4 - round(b * 4)) * 2, 6) AS error FROM b",
    "b10_digit_alternatives": f"WITH {EVENTS}, d AS (SELECT id, v, v // 100 AS h, v // 10 % 10 AS t, v % 10 AS o FROM events_), m AS (SELECT *, unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS b FROM d), r AS (SELECT id, v, v + CASE WHEN b & 1 > 0 AND o = 5 THEN 4 ELSE 0 END + CASE WHEN b & 2 > 0 AND t = 5 THEN 40 ELSE 0 END + CASE WHEN b & 4 > 0 AND h = 5 THEN 400 ELSE 0 END AS x FROM m), a AS (SELECT id, v, x FROM r UNION SELECT id, v, x - 100 FROM r) SELECT DISTINCT id, v, x AS alternative FROM a WHERE x BETWEEN 0 AND 400",
    "b11_screen_checks": "WITH s AS (SELECT l_orderkey, l_partkey, CAST(l_quantity AS BIGINT) AS p, l_partkey % 10 AS g, l_orderkey % 4 = 0 AS broke, CASE WHEN l_suppkey % 9 <> 0 THEN CAST(l_quantity AS BIGINT) + l_linenumber - 2 END AS x FROM lineitem), c AS (SELECT l_orderkey, l_partkey, CASE WHEN x IS NULL THEN 'cells' WHEN x > p + g AND NOT broke THEN 'combo_high+combo_low' WHEN x > p + g THEN 'combo_high' WHEN NOT broke AND x <> p + g THEN 'combo_low' ELSE '' END AS checks FROM s) SELECT checks, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(sum(l_partkey) AS BIGINT) AS parts FROM c GROUP BY checks",
    "b12_noise_filter": f"WITH {EVENTS} SELECT series, id, v, conf FROM events_ WHERE conf >= 0.25 AND v BETWEEN 4 AND 300",
    "b13_judged_symbol": f"WITH {EVENTS} SELECT id, ['1', '0', '2', '2', '0', '0', '1', 'X'][k % 8 + 1] AS symbol, k % 8 IN (4, 5) AS fake FROM events_",
    "a10_pick_band": f"WITH {EVENTS}, r AS (SELECT series AS vid, id, id % 3 AS p, CASE WHEN series % 2 = 0 AND id % 3 = 0 THEN NULL ELSE v END AS v FROM events_), m AS (SELECT vid, min(p) AS p FROM r WHERE v IS NOT NULL GROUP BY vid) SELECT r.vid, id, ['C', 'L', 'R'][r.p + 1] AS band, v FROM r JOIN m ON r.vid = m.vid AND r.p = m.p",
}
