"""Queries F1 to F11 (F2 is with the intervals)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import match as op
from .adapters import EVENTS, HOUR, events, table

BY = ["series"]


def match_one_to_one(spark, sf):
    """Clicks against purchases, within ten hours."""
    return op.match_one_to_one(events(spark, sf, "click"), events(spark, sf, "purchase"), BY, 10 * HOUR)


def match_mutual(spark, sf):
    return op.match_mutual(events(spark, sf, "click"), events(spark, sf, "purchase"), BY, 10 * HOUR)


def classify_edits(spark, sf):
    k, v = F.col("k"), F.col("v")
    rows = events(spark, sf).select(
        "id", F.element_at(F.array(*map(F.lit, ("pair", "extra", "missing"))), (F.col("id") % 3 + 1).cast("int")).alias("kind"), (k % 2 == 0).alias("file_hold"), (v % 2 == 0).alias("seen_hold"),
        (k / 500 - 0.1).alias("tail_error"), (v % 10 / 10).alias("rail_share"), (k % 5 == 0).alias("fake"), (k % 3 != 0).alias("flashed"), (v % 20 / 100).alias("gap_same"),
        (k % 12).alias("frames"), F.lit(10).alias("median_frames"), (v % 7 == 0).alias("other_column"), (k % 4 == 0).alias("has_rail"),
    )
    return op.classify_edits(rows).select("id", "edit")


def diff_events(spark, sf):
    """Line items of two versions: one without suppliers 0, 7, ..., one without returns and with changed flags for part 0, 5, ..."""
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("f"), F.min("l_suppkey").alias("s"), F.min("l_partkey").alias("p"))
    a = rows.filter("s % 7 <> 0").select("l_orderkey", "l_linenumber", F.col("f").alias("sym"))
    b = rows.filter("f <> 'R'").select("l_orderkey", "l_linenumber", F.when(F.col("p") % 5 == 0, "X").otherwise(F.col("f")).alias("sym"))
    return op.diff_events(a, b, ["l_orderkey", "l_linenumber"]).groupBy("kind", "a_symbol", "b_symbol").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


def part_sets(spark, sf):
    """F5's similarity: part brands of an order against those of the next order."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey").groupBy("l_orderkey").agg(F.collect_set("p_type").alias("types"))
    pairs = rows.join(rows.select((F.col("l_orderkey") - 1).alias("l_orderkey"), F.col("types").alias("next")), "l_orderkey")
    return pairs.select("l_orderkey", F.round(op.jaccard(F.col("types"), F.col("next")), 6).alias("jaccard"))


def pair_cascade(spark, sf):
    """Orders of a customer as blocks: odd ones ours, even ones theirs."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("events"), F.count("*").alias("meter"))
    rows = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("block"), F.sha2("o_orderpriority", 256).alias("sha"), "events", F.col("meter").cast("int").alias("meter"))
    return op.pair_cascade(rows.filter("block % 2 = 1"), rows.filter("block % 2 = 0"), ["cust"])


def match_catalog(spark, sf):
    """Parts as records, and every third part as a catalog, by name, type, brand and size."""
    rows = table(spark, sf, "part")
    recs = rows.select(F.col("p_partkey").alias("rec"), F.col("p_name").alias("song"), F.col("p_type").alias("type"), F.col("p_brand").alias("mix"), (F.col("p_size") % 10).alias("level"))
    catalog = rows.filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("chart"), F.col("p_name").alias("song"), F.col("p_type").alias("type"), F.col("p_brand").alias("mix"), (F.col("p_size") % 10).alias("level"), (F.col("p_partkey") % 4 == 0).alias("current"))
    return op.match_catalog(recs, catalog).select("rec", "match", "chart")


def newest_source(spark, sf):
    """Orders as uploads whose codes are their parts' brands and sizes; eras follow the keys."""
    code = F.concat_ws("/", "p_brand", "p_size")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("chart"), F.lit("s").alias("name"), code.alias("code"), (F.col("p_partkey") % 4).cast("int").alias("era"))
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), code.alias("code")), "l_partkey").groupBy("l_orderkey").agg(F.collect_set("code").alias("codes"))
    titles = lines.select(F.col("l_orderkey").alias("source"), F.col("l_orderkey").alias("seen"), (F.col("l_orderkey") % 4).cast("int").alias("era"), F.lit("s").alias("name"), "codes")
    current = part.filter("chart % 2 = 0").select("chart", (F.col("chart") % 50).alias("source"), F.when(F.col("chart") % 6 != 0, F.col("chart") % 3).cast("int").alias("era"))
    return op.newest_source(titles, part, current)


def sides(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("level")).filter("l_linenumber <= 2")
    return op.sides(lines.select("l_orderkey", F.col("l_linenumber").alias("code"), "level"), ["l_orderkey"])


def copies_disagree(spark, sf):
    """Orders of a customer and status as copies of a file; their lines' flags as blocks."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    files = rows.select(F.concat("o_custkey", F.lit("/"), "o_orderstatus").alias("name"), F.col("o_orderkey").alias("copy"), F.col("o_orderdate").cast("string").alias("date"), F.sha2("l_returnflag", 256).alias("block_sha"))
    return op.copies_disagree(files).select("name", "copy", "signature", "current", "agrees")


def twins(spark, sf):
    return op.twins(table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size"), ["p_name", "p_type", "p_size"], "p_partkey").select("p_partkey", "n", "twin")


def twin_documents(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha")).filter("sha IS NOT NULL")
    return op.twins(rows, ["sha"], "doc_id").select("doc_id", "n", "twin")


def resolve_reference(spark, sf):
    """A line count for each order: from its lines where there are over four, else from its priority, else from its customer's segment."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("expected")).filter("expected > 4")
    priority = orders.filter("o_orderpriority LIKE '1%'").select("o_orderkey", F.lit(1).cast("long").alias("expected"))
    segment = orders.join(table(spark, sf, "customer").filter("c_mktsegment = 'HOUSEHOLD'"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.lit(2).cast("long").alias("expected"))
    return op.resolve_reference(orders.select("o_orderkey"), {"lines": lines, "priority": priority, "segment": segment}, ["o_orderkey"])


def name_scan(spark, sf):
    """The first four words of each benchmark passage, wherever documents have them."""
    names = table(spark, sf, "benchmark").select(F.array_join(F.slice(F.split("text", " "), 1, 4), " ").alias("name")).distinct()
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text")
    return op.name_scan(docs, names)


def phrase_scan(spark, sf):
    """Whole benchmark passages, wherever documents have all their words in a row."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text")
    names = table(spark, sf, "benchmark").select(F.col("text").alias("name"))
    return op.phrase_scan(docs, names).select("doc", F.sha2("name", 256).alias("passage"))


QUERIES = {
    "f1_match_one_to_one": match_one_to_one, "f1_match_mutual": match_mutual, "f3_classify_edits": classify_edits, "f4_diff_events": diff_events, "f5_jaccard": part_sets, "f5_pair_cascade": pair_cascade, "f6_match_catalog": match_catalog,
    "f7_newest_source": newest_source, "f7_sides": sides, "f8_copies_disagree": copies_disagree, "f9_twins": twins, "f9_twin_documents": twin_documents, "f10_resolve_reference": resolve_reference, "f11_name_scan": name_scan, "f11_phrase_scan": phrase_scan,
}

_L = "SELECT l_orderkey, l_linenumber, max(l_returnflag) AS f, min(l_suppkey) AS s, min(l_partkey) AS p FROM lineitem GROUP BY ALL"

SQL = {
    "f1_match_mutual": f"WITH {EVENTS}, a AS (SELECT DISTINCT series, t FROM events_ WHERE kind = 'click'), b AS (SELECT DISTINCT series, t FROM events_ WHERE kind = 'purchase'), p AS (SELECT a.series, a.t AS obs, b.t AS ref, row_number() OVER (PARTITION BY a.series, a.t ORDER BY abs(a.t - b.t), b.t) AS x, row_number() OVER (PARTITION BY a.series, b.t ORDER BY abs(a.t - b.t), a.t) AS y FROM a JOIN b ON a.series = b.series) SELECT series, obs, ref FROM p WHERE x = 1 AND y = 1 AND abs(obs - ref) <= {10 * HOUR}",
    "f3_classify_edits": f"WITH {EVENTS} SELECT id, CASE WHEN id % 3 = 0 THEN CASE WHEN k % 2 = 1 AND v % 2 = 0 THEN 'tap_to_hold' WHEN k % 2 = 0 AND abs(k / 500 - 0.1) > 0.06 THEN 'move_tail' WHEN k % 2 = 0 AND v % 10 < 5 THEN 'thin_rail' ELSE 'same' END WHEN id % 3 = 2 THEN CASE WHEN k % 5 = 0 THEN 'fake' WHEN k % 3 = 0 THEN 'unflashed' ELSE 'unseen' END ELSE CASE WHEN v % 20 <= 3 THEN 'duplicate' WHEN k % 12 < 6 THEN 'short_streak' WHEN v % 7 = 0 THEN 'column_confusion' WHEN k % 4 = 0 THEN 'add_hold' ELSE 'add_tap' END END AS edit FROM events_",
    "f4_diff_events": f"WITH r AS ({_L}), a AS (SELECT l_orderkey, l_linenumber, f FROM r WHERE s % 7 <> 0), b AS (SELECT l_orderkey, l_linenumber, CASE WHEN p % 5 = 0 THEN 'X' ELSE f END AS f FROM r WHERE f <> 'R'), j AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS o, CASE WHEN b.f IS NULL THEN 'only_a' WHEN a.f IS NULL THEN 'only_b' WHEN a.f = b.f THEN 'same' ELSE 'changed' END AS kind, a.f AS a_symbol, b.f AS b_symbol FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber) SELECT kind, a_symbol, b_symbol, count(*) AS n, CAST(sum(o) AS BIGINT) AS keys FROM j GROUP BY ALL",
    "f5_jaccard": "WITH t AS (SELECT DISTINCT l_orderkey AS o, p_type FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT o, count(*) AS n FROM t GROUP BY o), b AS (SELECT x.o, count(y.p_type) AS bo FROM t x LEFT JOIN t y ON y.o = x.o + 1 AND y.p_type = x.p_type GROUP BY x.o) SELECT b.o AS l_orderkey, round(bo / (n1.n + n2.n - bo), 6) AS jaccard FROM b JOIN n n1 ON n1.o = b.o JOIN n n2 ON n2.o = b.o + 1",
    "f6_match_catalog": """WITH r AS (SELECT p_partkey AS rec, p_name AS song, p_type AS type, p_brand AS mix, p_size % 10 AS level FROM part), c AS (SELECT *, rec % 4 = 0 AS cur FROM r WHERE rec % 3 = 0),
        g AS (SELECT r.rec, count(c.rec) AS n, count(DISTINCT c.rec) FILTER (c.level = r.level AND c.mix = r.mix) AS a, count(DISTINCT c.rec) FILTER (c.level = r.level) AS b, count(DISTINCT c.rec) FILTER (c.level = r.level AND cur) AS d,
              min(c.rec) FILTER (c.level = r.level AND c.mix = r.mix) AS ca, min(c.rec) FILTER (c.level = r.level) AS cb, min(c.rec) FILTER (c.level = r.level AND cur) AS cd FROM r LEFT JOIN c ON r.song = c.song AND r.type = c.type GROUP BY r.rec)
        SELECT rec, CASE WHEN a = 1 THEN 'own_mix' WHEN b = 1 THEN 'any_mix' WHEN d = 1 THEN 'current' WHEN b > 1 THEN 'ambiguous' WHEN n > 0 THEN 'unmatched_level' ELSE 'unmatched_song' END AS match, CASE WHEN a = 1 THEN ca WHEN b = 1 THEN cb WHEN d = 1 THEN cd END AS chart FROM g""",
    "f7_newest_source": """WITH c AS (SELECT p_partkey AS chart, p_brand || '/' || p_size AS code, p_partkey % 4 AS era FROM part), t AS (SELECT DISTINCT l_orderkey AS source, l_orderkey % 4 AS e, p_brand || '/' || p_size AS code FROM lineitem JOIN part ON l_partkey = p_partkey),
        b AS (SELECT chart, source, e FROM c JOIN t ON c.code = t.code AND c.era = t.e QUALIFY row_number() OVER (PARTITION BY chart ORDER BY e DESC, source) = 1),
        n AS (SELECT p_partkey AS chart, p_partkey % 50 AS now, CASE WHEN p_partkey % 6 <> 0 THEN p_partkey % 3 END AS nera FROM part WHERE p_partkey % 2 = 0)
        SELECT c.chart, b.source, b.e AS era, CASE WHEN now IS NULL THEN 'none' WHEN b.source = now THEN 'current' WHEN nera IS NULL THEN 'unknown' WHEN b.e > nera THEN 'upgrade' ELSE 'as_new' END AS action FROM c JOIN b ON c.chart = b.chart LEFT JOIN n ON c.chart = n.chart""",
    "f7_sides": "WITH l AS (SELECT l_orderkey, l_linenumber AS code, max(l_quantity) AS level FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL) SELECT *, CASE WHEN count(*) OVER (PARTITION BY l_orderkey) = 1 THEN 'Center' WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY level, code) = 1 THEN 'Left' ELSE 'Right' END AS side FROM l",
    "f8_copies_disagree": "WITH s AS (SELECT o_custkey || '/' || o_orderstatus AS name, o_orderkey AS copy, o_orderdate AS d, sha256(string_agg(sha256(l_returnflag), ',' ORDER BY sha256(l_returnflag))) AS signature FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) SELECT name, copy, signature, row_number() OVER w = 1 AS current, signature = first_value(signature) OVER w AS agrees FROM s WINDOW w AS (PARTITION BY name ORDER BY d DESC, copy)",
    "f9_twins": "SELECT p_partkey, count(*) OVER w AS n, CASE WHEN p_partkey = min(p_partkey) OVER w THEN lead(p_partkey) OVER (w2) ELSE min(p_partkey) OVER w END AS twin FROM part WINDOW w AS (PARTITION BY p_name, p_type, p_size), w2 AS (PARTITION BY p_name, p_type, p_size ORDER BY p_partkey) QUALIFY count(*) OVER w > 1",
    "f9_twin_documents": "SELECT doc_id, count(*) OVER w AS n, CASE WHEN doc_id = min(doc_id) OVER w THEN lead(doc_id) OVER (w2) ELSE min(doc_id) OVER w END AS twin FROM documents WHERE text IS NOT NULL WINDOW w AS (PARTITION BY text), w2 AS (PARTITION BY text ORDER BY doc_id) QUALIFY count(*) OVER w > 1",
    "f10_resolve_reference": "WITH l AS (SELECT l_orderkey AS o, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 4) SELECT o_orderkey, coalesce(n, CASE WHEN o_orderpriority LIKE '1%' THEN 1 WHEN c_mktsegment = 'HOUSEHOLD' THEN 2 END) AS expected, CASE WHEN n IS NOT NULL THEN 'lines' WHEN o_orderpriority LIKE '1%' THEN 'priority' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'segment' END AS source FROM orders LEFT JOIN l ON o_orderkey = o LEFT JOIN customer ON o_custkey = c_custkey",
    "f11_phrase_scan": "WITH k AS (SELECT DISTINCT text, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS key FROM benchmark), d AS (SELECT doc_id AS doc, ' ' || regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') || ' ' AS t FROM documents) SELECT DISTINCT doc, sha256(text) AS passage FROM d JOIN k ON contains(t, ' ' || key || ' ') WHERE key <> ''",
    "f11_name_scan": "WITH n AS (SELECT DISTINCT array_to_string(string_split(text, ' ')[1:4], ' ') AS name FROM benchmark), k AS (SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS key FROM n), d AS (SELECT doc_id AS doc, ' ' || regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') || ' ' AS t FROM documents) SELECT DISTINCT doc, name FROM d JOIN k ON contains(t, ' ' || key || ' ') WHERE key <> ''",
}
