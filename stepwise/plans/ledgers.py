"""Queries H1 to H17: orders as charts, lines as nested charts, two versions by rule."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import ledgers as op
from .adapters import EVENTS, HOUR, events, lines, table

C, L = F.col, F.lit


def _orders(spark, sf):
    return table(spark, sf, "orders").select(C("o_orderkey").alias("chart"), "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


def merge_ledgers(spark, sf):
    """Three ledgers over orders: status and priority, some fields absent, some null."""
    k = C("chart")
    base = _orders(spark, sf)
    a = base.select("chart", F.array(L("status"), L("priority")).alias("present"), C("o_orderstatus").alias("status"), C("o_orderpriority").alias("priority"))
    b = base.filter(k % 3 == 0).select("chart", F.when(k % 2 == 0, F.array(L("status"))).otherwise(F.array(L("priority"))).alias("present"), L("B").alias("status"), F.when(k % 5 == 0, None).otherwise("b").alias("priority"))
    c = base.filter(k % 7 == 0).select((k + 1).alias("chart"), F.array(L("status")).alias("present"), F.when(k % 14 == 0, "C").alias("status"), L(None).cast("string").alias("priority"))
    return op.merge_ledgers([a, b, c], "chart", ["status", "priority"])


def merge_nested(spark, sf):
    """Line items of two ledgers: the second has every third part with a flag of its own."""
    rows = lines(spark, sf, "l_linenumber", "l_returnflag", "l_partkey").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"), F.min("l_partkey").alias("p"))
    later = rows.filter("p % 3 = 0").select("l_orderkey", (C("l_linenumber") + C("p") % 2).cast("int").alias("l_linenumber"), L("Z").alias("flag")).distinct()
    return op.merge_nested([rows, later], ["l_orderkey", "l_linenumber"], ["flag"])


def overlay_rekey(spark, sf):
    """Customers on keys; some ask to move to the key of the next, some of those clash."""
    k = C("c_custkey")
    rows = table(spark, sf, "customer").select(k.alias("chart"), k.alias("key"), C("c_mktsegment").alias("file"))
    moves = rows.filter("chart % 10 IN (1, 2, 5)").select("chart", C("key").alias("from_key"), F.when(C("chart") % 10 == 5, C("chart") + 1_000_000).otherwise(C("chart") + 1).alias("to_key"), F.when(C("chart") % 4 == 0, "other").otherwise(C("file")).alias("file"))
    return op.overlay_rekey(rows, moves)


def overlay_withdraw(spark, sf):
    cert = table(spark, sf, "lineitem").select(C("l_orderkey").alias("vid"), C("l_partkey").alias("chart"), C("l_returnflag").alias("side"))
    rows = table(spark, sf, "lineitem").filter("l_suppkey % 3 = 0").select(C("l_orderkey").alias("vid"), C("l_partkey").alias("chart"), L("R").alias("side"))
    return op.overlay_withdraw(cert, rows).groupBy("vid").agg(F.count("*").alias("n"), F.sum("chart").alias("charts"))


def population(spark, sf):
    """Lines as certifications of parts; suppliers as census, sizes as sweep."""
    cert = table(spark, sf, "lineitem").select(C("l_orderkey").alias("vid"), C("l_partkey").alias("chart"), F.when(C("l_returnflag") == "R", "CERTIFIED").otherwise("SEEN").alias("status"), F.when(C("l_linenumber") > 2, C("l_quantity").cast("long")).alias("expected"), C("l_shipdate").cast("string").alias("seq"))
    cert = cert.groupBy("vid", "chart", "status", "seq").agg(F.max("expected").alias("expected"))
    part = table(spark, sf, "part").select(C("p_partkey").alias("chart"), C("p_size").cast("long").alias("count"))
    return op.population(cert, part.filter("chart % 2 = 0"), part.filter("chart % 3 = 0").withColumn("count", C("chart")), part)


def append_only(spark, sf):
    """A ledger for each customer: its orders in order; later ones changed for every tenth customer."""
    order = Window.partitionBy("o_custkey").orderBy("chart")
    before = _orders(spark, sf).select(C("o_custkey").alias("ledger"), (F.row_number().over(order) - 1).alias("pos"), C("o_orderpriority").alias("line"))
    after = before.withColumn("line", F.when((C("ledger") % 10 == 0) & (C("pos") == 1), "changed").otherwise(C("line"))).filter("ledger % 17 <> 0 OR pos < 2")
    return op.append_only(before, after)


def verify_chain(spark, sf):
    """A chain for each customer over order priorities; one link broken for some."""
    order = Window.partitionBy("o_custkey").orderBy("chart")
    rows = _orders(spark, sf).select(C("o_custkey").alias("ledger"), C("chart").alias("seq"), C("o_orderpriority").alias("body"))
    link = F.sha2(F.concat(C("ledger").cast("string"), L("/"), C("seq").cast("string")), 256)
    rows = rows.withColumn("prev", link)
    first = F.row_number().over(Window.partitionBy("ledger").orderBy("seq")) == 1
    rows = rows.withColumn("prev", F.when(first, "0" * 64).otherwise(C("prev"))).withColumn("hash", F.sha2(F.concat("prev", "body"), 256))
    rows = rows.withColumn("prev", F.when(first, C("prev")).otherwise(F.when(C("ledger") % 2 == 0, F.lag("hash").over(Window.partitionBy("ledger").orderBy("seq"))).otherwise(C("prev"))))
    del order
    return op.verify_chain(rows)


def _demoted(spark, sf):
    """Every sixth order demoted for the block it has; some rows blank, new or signed."""
    k = C("chart")
    rows = _orders(spark, sf).filter(k % 6 == 0)
    return rows.select("chart", F.sha2(F.when(k % 18 == 0, "other").otherwise(C("o_orderpriority")), 256).alias("block_sha"), F.when(k % 4 == 0, "re-read").otherwise(" ").alias("reason"), L("video").alias("evidence"), F.when(k % 8 == 0, "me").alias("owner"), (k % 10 == 0).alias("added"))


def _promoted(spark, sf):
    k = C("chart")
    return _orders(spark, sf).filter(k % 5 == 0).select("chart", F.when(k % 10 == 5, "short").otherwise(F.sha2("o_orderpriority", 256)).alias("block_sha"), F.when(k % 15 == 0, "STEEP").otherwise("FLAT").alias("audit"), (k % 25 != 0).alias("covered"))


def assign_tiers(spark, sf):
    k = C("chart")
    rows = _orders(spark, sf).select("chart", F.sha2("o_orderpriority", 256).alias("block_sha"), (k % 2 == 0).alias("exact"))
    flagged = rows.filter(k % 7 == 0).select("chart", F.when(k % 14 == 0, "quarantine").otherwise("owner_revisit").alias("flag"))
    out = op.assign_tiers(rows, rows.filter(k % 3 == 0).select("chart"), _demoted(spark, sf), _promoted(spark, sf), flagged)
    return out.select("chart", "protected_by", "tier", F.array_join("flags", ",").alias("flags"))


def gate(spark, sf):
    """Orders graded by the parity of their keys; a later version edits, drops, gains and loses some."""
    k = C("chart")
    rows = _orders(spark, sf).select("chart", F.sha2("o_orderpriority", 256).alias("block_sha"), C("o_orderstatus").alias("header_sha"), (k % 8).alias("expected"))
    tier = lambda df, p: df.withColumn("protected_by", F.when(p, "import")).withColumn("tier", F.when(p, "PROTECTED").when(C("exact"), "PROVISIONAL"))
    base = tier(rows.filter(k % 11 != 0).withColumn("exact", k % 2 == 0), k % 3 == 0)
    later = rows.filter(k % 13 != 0).withColumn("exact", F.when(k % 16 < 2, k % 2 == 1).otherwise(k % 2 == 0))
    later = later.withColumn("block_sha", F.when(k % 5 == 1, F.sha2(L("edited"), 256)).otherwise(C("block_sha"))).withColumn("header_sha", F.when(k % 17 == 0, "edited").otherwise(C("header_sha"))).withColumn("expected", F.when(k % 19 == 0, 99).otherwise(C("expected")))
    head = tier(later, (k % 3 == 0) & (k % 4 != 0) | (k % 23 == 0))
    promoted = rows.filter(k % 10 == 6).select("chart", F.sha2(L("edited"), 256).alias("block_sha"), L("FLAT").alias("audit"), L(True).alias("covered"))
    flagged = rows.filter(k % 7 == 0).select("chart", F.when(k % 14 == 0, "quarantine").otherwise("oracle_conflict").alias("flag"))
    return op.gate(base, head, _demoted(spark, sf), promoted, flagged)


def declared_net(spark, sf):
    return op.declared_net(gate(spark, sf), 0)


def build_conflicts(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(C("l_orderkey").alias("chart")).agg(F.count("*").alias("implied"))
    rows = table(spark, sf, "orders").select(C("o_orderkey").alias("chart"), C("o_custkey").alias("vid"), C("o_orderstatus").alias("side"), (C("o_orderkey") % 3 == 0).alias("verified"), (C("o_orderkey") % 5).alias("expected"), F.concat("o_orderpriority", C("o_totalprice").cast("int").cast("string")).alias("block_sha")).join(lines, "chart")
    out = op.build_conflicts(rows, lines.select("chart", (C("implied") - F.when(C("chart") % 4 == 0, 1).otherwise(0)).alias("count")))
    return out.select("chart", F.array_join("reasons", ",").alias("reasons"))


def diff_ledgers(spark, sf):
    k = C("chart")
    ledger = _orders(spark, sf).select("chart", C("o_orderstatus").alias("status"), C("o_orderpriority").alias("priority"))
    base = ledger.withColumn("priority", F.when(k % 9 == 0, "drifted").otherwise(C("priority")))
    new = base.withColumn("status", F.when(k % 8 == 0, "moved").otherwise(C("status"))).withColumn("priority", F.when(k % 12 == 0, None).otherwise(C("priority")))
    return op.diff_ledgers(ledger, base, new, ["chart"], ["status", "priority"], ledger.filter(k % 16 == 0).select("chart"))


def what_if(spark, sf):
    """Grading customers by their number of orders, with and without an extra quarter of the orders."""
    rows = _orders(spark, sf).select(C("o_custkey").alias("chart"), C("chart").alias("o")).filter("o % 4 <> 0")
    grade = lambda df: df.groupBy("chart").agg(F.when(F.count("*") >= 8, "many").otherwise("few").alias("verdict"))
    extra = _orders(spark, sf).select(C("o_custkey").alias("chart"), C("chart").alias("o")).filter("o % 4 = 0")
    return op.what_if(grade, rows, extra)


def changed_blocks(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text")
    a = rows.filter("doc_id % 10 <> 0").withColumn("text", F.regexp_replace("text", "\n", "\r\n"))
    b = rows.filter("doc_id % 12 <> 0").withColumn("text", F.when(C("doc_id") % 7 == 0, F.concat("text", L("!"))).otherwise(C("text")))
    return op.changed_blocks(a, b, ["doc_id"])


def blast_radius(spark, sf):
    k = C("key")
    rows = table(spark, sf, "part").select(C("p_partkey").alias("key"), C("p_name").alias("grid"), C("p_size").alias("ticks"))
    new = rows.filter(k % 9 != 0).withColumn("grid", F.when(k % 5 == 0, "moved").otherwise(C("grid"))).withColumn("ticks", F.when(k % 7 == 0, None).otherwise(C("ticks")))
    return op.blast_radius(rows.filter(k % 8 != 0), new, rows.filter(k % 3 == 0).select("key"))


def verify_release(spark, sf):
    orders = table(spark, sf, "orders").select(C("o_orderkey").cast("string").alias("name"), "o_orderkey", "o_custkey", "o_totalprice")
    orphans = table(spark, sf, "lineitem").join(orders, C("l_orderkey") == C("o_orderkey"), "left_anti").select(C("l_orderkey").cast("string").alias("name"))
    empty = orders.join(table(spark, sf, "lineitem").select(C("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("name")
    out = op.verify_release([("price", orders, C("o_totalprice") <= 0), ("orphan_lines", orphans, L(True)), ("empty_orders", empty, L(True))])
    return out.select("check", "ok", "n_bad", F.array_join("samples", ",").alias("samples"))


def release_gaps(spark, sf):
    rows = table(spark, sf, "part").select(C("p_partkey").alias("name"), F.sha1("p_name").alias("sha"))
    return op.release_gaps(rows.filter("name % 10 <> 0"), rows.filter("name % 15 <> 0").withColumn("sha", F.when(C("name") % 7 == 0, "x").otherwise(C("sha"))))


def guarded_update(spark, sf):
    changes = table(spark, sf, "customer").filter("c_custkey % 4 = 0").select("c_custkey", F.when(C("c_custkey") % 8 == 0, C("c_mktsegment")).otherwise("STALE").alias("old"), L("NEW").alias("new"))
    return op.guarded_update(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), changes, "c_custkey", "c_mktsegment")


def audit_series(spark, sf):
    reads = events(spark, sf).filter("id % 200 > 20").select(C("series").alias("vid"), "t")
    n = events(spark, sf).groupBy(C("series").alias("vid")).agg(F.count("*").alias("n"), F.min("t").alias("start"), F.max("t").alias("end"))
    files = n.select("vid", F.when(C("vid") % 9 == 0, 0).otherwise(C("n") * 20).alias("bytes"), F.when(C("vid") % 4 == 0, C("n") - 7).alias("sidecar_lines"), (C("vid") % 11 != 0).alias("has_file"))
    return op.audit_series(files, reads, n.select("vid", "start", "end", (C("vid") % 5 == 0).alias("ranged")), 20 * HOUR)


def dedupe_compute(spark, sf):
    """The length of each text, computed once for each distinct text."""
    rows = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), "text")
    texts = rows.groupBy("sha").agg(F.min("text").alias("text"))
    out = op.dedupe_compute(rows.select("doc_id", "sha"), ["sha"], lambda keys: keys.join(texts, "sha").select("sha", F.length("text").cast("long").alias("points")))
    return out.select("doc_id", "points")


QUERIES = {
    "h1_merge_ledgers": merge_ledgers, "h1_merge_nested": merge_nested, "h2_overlay_rekey": overlay_rekey, "h3_overlay_withdraw": overlay_withdraw, "h4_population": population, "h5_append_only": append_only, "h6_verify_chain": verify_chain,
    "h7_assign_tiers": assign_tiers, "h8_gate": gate, "h8_declared_net": declared_net, "h9_build_conflicts": build_conflicts, "h10_diff_ledgers": diff_ledgers, "h11_what_if": what_if, "h12_changed_blocks": changed_blocks,
    "h13_blast_radius": blast_radius, "h14_verify_release": verify_release, "h14_release_gaps": release_gaps, "h15_guarded_update": guarded_update, "h16_audit_series": audit_series, "h17_dedupe_compute": dedupe_compute,
}

_V = """d AS (SELECT o_orderkey AS c, CASE WHEN o_orderkey % 18 = 0 THEN 'other' ELSE o_orderpriority END AS s, coalesce(o_orderkey % 8 = 0, false) AS signed, o_orderkey % 10 = 0 AS added, o_orderkey % 4 = 0 AS fit FROM orders WHERE o_orderkey % 6 = 0),
    b AS (SELECT o_orderkey AS c, o_orderpriority AS s, o_orderstatus AS t, o_orderkey % 8 AS x, o_orderkey % 2 = 0 AS e, o_orderkey % 3 = 0 AS p FROM orders WHERE o_orderkey % 11 <> 0),
    h AS (SELECT o_orderkey AS c, CASE WHEN o_orderkey % 5 = 1 THEN 'edited' ELSE o_orderpriority END AS s, CASE WHEN o_orderkey % 17 = 0 THEN 'edited' ELSE o_orderstatus END AS t, CASE WHEN o_orderkey % 19 = 0 THEN 99 ELSE o_orderkey % 8 END AS x, CASE WHEN o_orderkey % 16 < 2 THEN o_orderkey % 2 = 1 ELSE o_orderkey % 2 = 0 END AS e, o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0 OR o_orderkey % 23 = 0 AS p FROM orders WHERE o_orderkey % 13 <> 0),
    j AS (SELECT coalesce(b.c, h.c) AS c, b.c IS NOT NULL AS had, h.c IS NOT NULL AS has, coalesce(b.e, false) AS e0, coalesce(h.e, false) AS e1, b.c IS NOT NULL AND h.c IS NOT NULL AND (b.s <> h.s OR b.t <> h.t) AS ed, b.s <> h.s AS block, b.t = h.t AS head, b.x <> h.x AS moved, coalesce(b.p, false) AS p0, coalesce(h.p, false) AS p1, b.s, coalesce(h.s = 'edited' AND coalesce(b.c, h.c) % 10 = 6, false) AS up FROM b FULL JOIN h ON b.c = h.c),
    t AS (SELECT *, CASE WHEN e0 AND NOT e1 THEN CASE WHEN has THEN 'LOST' ELSE 'LEFT-EXACT' END WHEN e1 AND NOT e0 THEN CASE WHEN had THEN 'GAINED' ELSE 'ENTERED-EXACT' END WHEN ed THEN CASE WHEN e0 THEN 'EDITED-EXACT' ELSE 'EDITED-OFF' END WHEN had AND has AND moved THEN 'EXPECTED-CHANGED' WHEN NOT had THEN 'ENTERED' WHEN NOT has THEN 'LEFT' WHEN p0 AND NOT p1 THEN 'UNPROTECTED' WHEN p1 AND NOT p0 THEN 'PROMOTED' END AS transition FROM j),
    k AS (SELECT t.*, f.signed AS sb, n.signed AS sn FROM t LEFT JOIN d f ON f.c = t.c AND f.s = t.s AND f.fit LEFT JOIN d n ON n.c = t.c AND n.added AND n.fit WHERE transition IS NOT NULL),
    w AS (SELECT *, CASE WHEN transition IN ('LOST', 'LEFT-EXACT') THEN CASE WHEN p0 THEN 'protected_lost' WHEN sb IS NULL THEN 'lost_without_demotion' WHEN c % 14 = 0 AND NOT sb THEN 'demotion_not_signed' END WHEN transition = 'EDITED-EXACT' THEN CASE WHEN p0 AND NOT (up AND head) THEN CASE WHEN block THEN 'protected_block_edited' ELSE 'protected_header_edited' END END WHEN transition IN ('GAINED', 'ENTERED-EXACT') AND c % 14 = 7 THEN 'conflict_gained' WHEN transition = 'UNPROTECTED' THEN CASE WHEN coalesce(sb, sn) IS NULL THEN 'unprotected_without_demotion' WHEN c % 14 = 0 AND NOT coalesce(sb, sn) THEN 'demotion_not_signed' END END AS fails FROM k),
    g AS (SELECT c AS chart, transition, CASE WHEN p0 THEN 'PROTECTED' WHEN had AND e0 THEN 'PROVISIONAL' END AS tier_base, CASE WHEN p1 THEN 'PROTECTED' WHEN has AND e1 THEN 'PROVISIONAL' END AS tier_head, fails, CASE WHEN fails IS NULL AND ed THEN CASE transition WHEN 'GAINED' THEN 'import' WHEN 'EDITED-EXACT' THEN 'base' END END AS audit FROM w UNION ALL SELECT c, 'LEDGER', NULL, NULL, 'demotion_without_owner', NULL FROM d WHERE added AND NOT signed)"""

SQL = {
    "h1_merge_ledgers": "WITH a AS (SELECT o_orderkey AS chart, o_orderstatus AS status, o_orderpriority AS priority FROM orders), b AS (SELECT chart, chart % 2 = 0 AS hs, CASE WHEN chart % 5 <> 0 THEN 'b' END AS p FROM a WHERE chart % 3 = 0), c AS (SELECT chart + 1 AS chart, CASE WHEN chart % 14 = 0 THEN 'C' END AS s FROM a WHERE chart % 7 = 0), k AS (SELECT chart FROM a UNION SELECT chart FROM c) SELECT k.chart, CASE WHEN c.chart IS NOT NULL THEN c.s WHEN b.hs THEN 'B' ELSE a.status END AS status, CASE WHEN NOT b.hs THEN b.p ELSE a.priority END AS priority FROM k LEFT JOIN a ON k.chart = a.chart LEFT JOIN b ON k.chart = b.chart LEFT JOIN c ON k.chart = c.chart",
    "h1_merge_nested": "WITH a AS (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS flag, min(l_partkey) AS p FROM lineitem GROUP BY ALL), b AS (SELECT DISTINCT l_orderkey, CAST(l_linenumber + p % 2 AS INT) AS l_linenumber FROM a WHERE p % 3 = 0) SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber, CASE WHEN b.l_orderkey IS NOT NULL THEN 'Z' ELSE flag END AS flag FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber",
    "h2_overlay_rekey": "WITH m AS (SELECT c_custkey AS c, c_mktsegment AS f, c_custkey % 10 IN (1, 2, 5) AND c_custkey % 4 <> 0 AS asks, (SELECT max(c_custkey) FROM customer) AS top FROM customer), r AS (SELECT c, f, top, asks, CASE WHEN c % 10 = 5 THEN asks WHEN c % 10 = 2 THEN asks AND c = top WHEN c % 10 = 1 THEN asks AND c = top ELSE false END AS moved FROM m) SELECT c AS chart, CASE WHEN moved THEN CASE WHEN c % 10 = 5 THEN c + 1000000 ELSE c + 1 END ELSE c END AS key, f AS file, moved FROM r",
    "h3_overlay_withdraw": "WITH w AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_suppkey % 3 = 0) SELECT l_orderkey AS vid, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS charts FROM lineitem l WHERE NOT (l_returnflag = 'R' AND EXISTS (SELECT 1 FROM w WHERE w.l_orderkey = l.l_orderkey AND w.l_partkey = l.l_partkey)) GROUP BY 1",
    "h4_population": "WITH c AS (SELECT l_orderkey AS vid, l_partkey AS chart, l_shipdate AS seq, max(CASE WHEN l_linenumber > 2 THEN CAST(l_quantity AS BIGINT) END) AS e FROM lineitem WHERE l_returnflag = 'R' AND l_partkey % 2 = 0 GROUP BY ALL), x AS (SELECT *, row_number() OVER (PARTITION BY chart ORDER BY seq DESC, vid DESC) AS k FROM c) SELECT chart, vid, coalesce(e, CASE WHEN chart % 3 = 0 THEN chart END, p_size) AS expected FROM x JOIN part ON chart = p_partkey WHERE k = 1",
    "h5_append_only": "WITH b AS (SELECT o_custkey AS ledger, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, o_orderpriority AS line FROM orders), x AS (SELECT ledger, min(pos) FILTER (ledger % 10 = 0 AND pos = 1 OR ledger % 17 = 0 AND pos >= 2) AS f FROM b GROUP BY ledger) SELECT ledger, f IS NULL AS ok, f AS first_bad FROM x",
    "h6_verify_chain": "WITH n AS (SELECT o_custkey AS ledger, o_orderkey AS seq, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders), c AS (SELECT ledger, count(*) AS n, min(seq) FILTER (k = 2) AS second FROM n GROUP BY ledger) SELECT ledger, n, second AS first_break, CASE WHEN second IS NULL THEN NULL WHEN ledger % 2 = 0 THEN 'hash' ELSE 'prev' END AS reason FROM c",
    "h7_assign_tiers": "WITH r AS (SELECT o_orderkey AS c, o_orderkey % 3 = 0 AS i, o_orderkey % 12 = 0 AS down, o_orderkey % 12 = 0 AND o_orderkey % 18 <> 0 AS same, o_orderkey % 10 = 0 AND o_orderkey % 15 <> 0 AND o_orderkey % 25 <> 0 AS up FROM orders), t AS (SELECT *, CASE WHEN up AND NOT same THEN 'promotion' WHEN i AND NOT down THEN 'import' END AS p FROM r) SELECT c AS chart, p AS protected_by, CASE WHEN p IS NOT NULL THEN 'PROTECTED' WHEN c % 2 = 0 THEN 'PROVISIONAL' END AS tier, concat_ws(',', CASE WHEN down THEN 'demoted' END, CASE WHEN c % 14 = 0 THEN 'quarantine' WHEN c % 7 = 0 THEN 'owner_revisit' END) AS flags FROM t",
    "h8_gate": f"WITH {_V} SELECT * FROM g",
    "h8_declared_net": f"WITH {_V}, n AS (SELECT CAST(sum(CASE WHEN transition IN ('GAINED', 'ENTERED-EXACT') THEN 1 WHEN transition IN ('LOST', 'LEFT-EXACT') THEN -1 ELSE 0 END) AS BIGINT) AS net FROM g) SELECT net, 0 AS declared, net = 0 AS ok FROM n",
    "h9_build_conflicts": "WITH l AS (SELECT l_orderkey AS c, count(*) AS i FROM lineitem GROUP BY 1), r AS (SELECT c, i, o_orderkey % 3 = 0 AS v, c % 5 AS e, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS s, count(*) OVER (PARTITION BY o_orderpriority || CAST(trunc(o_totalprice) AS BIGINT)) AS t FROM l JOIN orders ON c = o_orderkey), x AS (SELECT c AS chart, concat_ws(',', CASE WHEN s > 1 AND NOT v THEN 'two_on_side' END, CASE WHEN e <> i AND c % 4 <> 0 THEN 'count_disagrees' END, CASE WHEN t > 1 THEN 'twin' END) AS reasons FROM r) SELECT * FROM x WHERE reasons <> ''",
    "h10_diff_ledgers": "WITH f AS (SELECT o_orderkey AS k, unnest(['status', 'priority']) AS field FROM orders), d AS (SELECT k AS chart, field, CASE WHEN field = 'status' THEN k % 8 = 0 ELSE k % 12 = 0 END AS changed, field = 'priority' AND k % 9 = 0 AS drift FROM f) SELECT *, CASE WHEN changed AND chart % 16 = 0 THEN 'INTENDED' WHEN changed THEN 'UNINTENDED' ELSE 'PRE_EXISTING' END AS class FROM d WHERE changed OR drift",
    "h11_what_if": "WITH g AS (SELECT o_custkey AS chart, count(*) FILTER (o_orderkey % 4 <> 0) AS a, count(*) AS b FROM orders GROUP BY 1) SELECT chart, CASE WHEN a = 0 THEN 'appears' WHEN (a >= 8) = (b >= 8) THEN 'both' ELSE 'changes' END AS state FROM g WHERE b > 0",
    "h12_changed_blocks": "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'added' WHEN doc_id % 12 = 0 THEN 'removed' ELSE 'changed' END AS change FROM documents WHERE NOT (doc_id % 10 = 0 AND doc_id % 12 = 0) AND text IS NOT NULL AND (doc_id % 10 = 0 OR doc_id % 12 = 0 OR doc_id % 7 = 0)",
    "h13_blast_radius": "WITH k AS (SELECT p_partkey AS key, p_partkey % 8 <> 0 AS o, p_partkey % 9 <> 0 AS n, p_partkey % 3 = 0 AS e, p_partkey % 5 = 0 OR p_partkey % 7 = 0 AS d FROM part), x AS (SELECT key, CASE WHEN NOT o AND NOT n THEN CASE WHEN e THEN 'silent' END WHEN NOT n THEN 'dropped' WHEN NOT o THEN 'added' WHEN d AND e THEN 'moved' WHEN d THEN 'stray' WHEN e THEN 'silent' END AS kind FROM k) SELECT * FROM x WHERE kind IS NOT NULL",
    "h14_verify_release": "WITH e AS (SELECT o_orderkey::VARCHAR AS name FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)), p AS (SELECT o_orderkey::VARCHAR AS name FROM orders WHERE o_totalprice <= 0), o AS (SELECT l_orderkey::VARCHAR AS name FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)), u AS (SELECT 'price' AS c, name FROM p UNION ALL SELECT 'orphan_lines', name FROM o UNION ALL SELECT 'empty_orders', name FROM e), n AS (SELECT unnest(['price', 'orphan_lines', 'empty_orders']) AS c), r AS (SELECT n.c, u.name, row_number() OVER (PARTITION BY n.c ORDER BY u.name) AS k FROM n LEFT JOIN u ON n.c = u.c) SELECT c AS \"check\", count(name) = 0 AS ok, count(name) AS n_bad, coalesce(string_agg(name, ',' ORDER BY name) FILTER (k <= 5), '') AS samples FROM r GROUP BY c",
    "h14_release_gaps": "SELECT p_partkey AS name, CASE WHEN p_partkey % 15 = 0 THEN 'missing_entry' WHEN p_partkey % 10 = 0 THEN 'orphan_entry' ELSE 'differs' END AS gap FROM part WHERE p_partkey % 30 <> 0 AND (p_partkey % 15 = 0 OR p_partkey % 10 = 0 OR p_partkey % 7 = 0)",
    "h15_guarded_update": "SELECT c_custkey, CASE WHEN c_custkey % 8 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment, c_custkey % 8 = 0 AS applied FROM customer",
    "h16_audit_series": f"WITH {EVENTS}, n AS (SELECT series AS vid, count(*) AS n, min(t) AS a0, max(t) AS b0, count(*) FILTER (id % 200 > 20) AS m, min(t) FILTER (id % 200 > 20) AS a, max(t) FILTER (id % 200 > 20) AS b FROM events_ GROUP BY 1) SELECT vid, CASE WHEN vid % 11 = 0 THEN 'orphan_sidecar' WHEN vid % 9 = 0 THEN 'empty' WHEN m = 0 THEN 'unloadable' WHEN vid % 4 = 0 AND n - 7 <> m THEN 'sidecar_mismatch' WHEN vid % 5 = 0 THEN 'range_scan' WHEN a > a0 + {20 * HOUR} THEN 'starts_late' WHEN b < b0 - {20 * HOUR} THEN 'truncated' ELSE 'fine' END AS class FROM n",
    "h17_dedupe_compute": "SELECT doc_id, length(text) AS points FROM documents",
}
