"""Queries I1 to I19: two versions or labelers over orders, lines, parts and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as op
from .adapters import EVENTS, events, lines, table

C, L = F.col, F.lit


def _kinds(spark, sf):
    k = C("k")
    return events(spark, sf).select(C("series").alias("chart"), F.when(k % 10 < 7, "pair").when(k % 10 < 9, "extra").otherwise("missing").alias("kind"), (C("v") % 4 == 0).alias("fake"))


def _round(df, *columns):
    return df.select(*(F.round(c, 6).alias(c) if c in columns else C(c) for c in df.columns))


def prf(spark, sf):
    return _round(op.prf(_kinds(spark, sf), ["chart"]), "recall", "precision", "f1")


def pooled(spark, sf):
    pairs = events(spark, sf).filter("k % 10 < 8").select(C("series").alias("chart"), ((C("v") - 250) / 4000).alias("error"))
    totals = events(spark, sf).groupBy(C("series").alias("chart")).agg(F.count("*").alias("n_obs"), (F.count("*") + 2).alias("n_ref"))
    return _round(op.pooled(pairs, totals, (0.03, 0.045, 0.06), 0.7), "recall", "precision", "f1", "p90")


def compare_runs(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy(C("l_orderkey").alias("chart"), C("l_linenumber").alias("col")).agg(F.min("l_partkey").alias("idx"), F.min("l_suppkey").alias("s"))
    return op.compare_runs(rows.filter("idx % 9 <> 0").withColumn("matched", C("s") % 2 == 0), rows.filter("idx % 7 <> 0").withColumn("matched", C("s") % 3 == 0))


def _sums(spark, sf):
    """Matches and notes of each user before and after, users in components of ten."""
    k, v = C("k"), C("v")
    rows = events(spark, sf).groupBy(C("series").alias("chart")).agg(F.count_if(k < 60).alias("m0"), (2 * F.count("*")).alias("n0"), F.count_if((k < 60) | (v % 9 == 0)).alias("m1"))
    return rows.withColumn("n1", C("n0") + C("chart") % 3).withColumn("component", F.floor(C("chart") / 10))


def component_bootstrap(spark, sf):
    return _round(op.component_bootstrap(_sums(spark, sf), 200, 7), "delta", "low")


def leave_top_k(spark, sf):
    return _round(op.leave_top_k(_sums(spark, sf), 5), "delta")


def judge(spark, sf):
    sums = _sums(spark, sf)
    summary = sums.agg(F.sum("m0").cast("double").alias("m0"), F.sum("m1").cast("double").alias("m1"), F.count("*").cast("double").alias("charts"))
    summary = summary.select(F.explode(F.array(*(F.struct(L(c).alias("name"), C(c).alias("value")) for c in ("m0", "m1", "charts")))).alias("s")).select("s.*")
    criteria = spark.createDataFrame([("m0", ">=", 100.0), ("m1", "<=", 10.0), ("charts", ">=", 5.0), ("absent", "=", 0.0)], "name string, op string, bound double")
    return op.judge(summary, criteria)


def components(spark, sf):
    """Parts that share brand, size and type, or name, size and type, transitively."""
    rows = table(spark, sf, "part").select("p_partkey", F.concat_ws("/", "p_brand", "p_size", "p_type").alias("a"), F.concat_ws("/", "p_name", "p_size", "p_type").alias("b"))
    return op.components(rows, "p_partkey", ["a", "b"])


def hash_split(spark, sf):
    rows = table(spark, sf, "orders").select(C("o_custkey").alias("component"), (C("o_orderkey") % 101 == 0).alias("pin"))
    return op.hash_split(rows, "salt", {"tune": 0.5, "validate": 0.3, "sealed": 0.2})


def balanced_halves(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return op.balanced_halves(rows, ["c_mktsegment"], "salt", "c_custkey")


def stratify(spark, sf):
    rows = table(spark, sf, "orders")
    rules = [("cheap", C("o_totalprice") < 40_000), ("open", C("o_orderstatus") == "O"), ("low", C("o_orderpriority") == "5-LOW")]
    out = op.stratify(rows, rules, C("o_orderkey") % 4 == 0, C("o_custkey") % 3 == 0)
    return out.select("o_orderkey", F.array_join("exclusions", ",").alias("exclusions"), "stratum")


def sentinels(spark, sf):
    notes = events(spark, sf).select("series", (C("k") % 5).alias("col"), "t")
    return _round(op.sentinels(notes, "series", 20, 24 * 3_600_000_000), "density")


def regress_rule(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(C("l_orderkey").alias("block")).agg(F.count("*").alias("n"), F.count_if(C("l_returnflag") == "R").alias("r"))
    tiers = lines.select("block", (C("block") % 7).alias("expected"), F.when(C("block") % 3 == 0, "pristine").when(C("block") % 3 == 1, "fitted").otherwise("excused").alias("tier"))
    return op.regress_rule(lines, lines.select("block", (C("n") - C("r")).alias("n")), tiers)


def null_rules(spark, sf):
    rows = table(spark, sf, "part").select((C("p_size") % 6).alias("n"), (C("p_partkey") % 6).alias("expected"), *(((C("p_partkey") * p) % 17 < 6).alias(f"f{p}") for p in (3, 5, 7, 11)), (C("p_type") == "ECONOMY").alias("economy"))
    return op.null_rules(rows, ["f3", "f5", "f7", "f11", "economy"], 1)


def assign_packets(spark, sf):
    items = table(spark, sf, "documents").select(C("doc_id").alias("item"), C("doc_id").alias("pos"))
    seeds = table(spark, sf, "region").select((C("r_regionkey") + 1_000_000).alias("seed"))
    return op.assign_packets(items, seeds, 20, 0.1, "salt").select("packet", "slot", "iid", "kind", "item")


def score_agreement(spark, sf):
    """Lines as packet items, three readers who answer with a flag, or wrongly or not by key."""
    keys = lines(spark, sf, "l_linenumber", "l_returnflag", "l_partkey").groupBy(C("l_orderkey").alias("packet"), C("l_linenumber").alias("i")).agg(F.max("l_returnflag").alias("answer"), F.min("l_partkey").alias("p"))
    keys = keys.withColumn("item", F.concat_ws("-", "packet", "i"))
    keyed = keys.select("packet", "item", F.when(C("i") == 1, "seed").otherwise("real").alias("kind"), "answer")
    answers = keys.select("packet", "item", "answer", "p", F.explode(F.array(*map(L, (2, 3, 5)))).alias("reader"))
    said = F.when(C("p") % (C("reader") * 7) == 0, "?").when(C("p") % (C("reader") * 5) == 0, "X").otherwise(C("answer"))
    given = answers.filter(C("p") % (C("reader") * 11) != 0)  # some questions stay open, seeds too
    return op.score_agreement(keyed, given.select("reader", "packet", "item", F.lower(said).alias("answer")))


def identify(spark, sf):
    """Users as series, suppliers of a tenth as candidates; scores from events."""
    rows = events(spark, sf).withColumn("candidate", C("k") % 6).groupBy("series", "candidate").agg((F.count("*") % 5 / 5).alias("score"), (F.count("*") % 3).alias("implied"), (F.min("k") % 4).alias("level"))
    rows = rows.withColumn("score", F.when(C("candidate") + C("series") % 7 != 3, C("score"))).select("*", (C("series") % 3).alias("expected"), (C("series") % 4).alias("wanted"), C("candidate").alias("place"), (C("candidate") == C("series") % 6).alias("own"))
    return _round(op.identify(rows, 0.3, 0.3), "score", "margin_runner", "margin_mapped")


def percentile_bands(spark, sf):
    rows = events(spark, sf).select("id", F.concat("kind", L("/"), (C("series") % 40).cast("string")).alias("grp"), "kind", "v", (C("k") >= 10).alias("passes"))
    out = op.percentile_bands(rows, "grp", "kind", "v", 15, 5.0, 0.05, 0.95)
    return _round(out.select("id", "low", "high", "source", "outlier"), "low", "high")


def golden_compare(spark, sf):
    rows = table(spark, sf, "part")
    field = lambda f, v: F.struct(L(f).alias("field"), v.cast("string").alias("value"))
    expected = rows.filter("p_partkey % 4 = 0").select("p_partkey", F.explode(F.array(field("name", C("p_name")), field("size", C("p_size")))).alias("f")).select("p_partkey", "f.*")
    got = rows.filter("p_partkey % 12 <> 0").select("p_partkey", F.explode(F.array(field("name", C("p_name")), field("size", F.when(C("p_partkey") % 5 == 0, 99).otherwise(C("p_size"))), field("brand", C("p_brand")))).alias("f")).select("p_partkey", "f.*")
    return op.golden_compare(expected, got, "p_partkey")


def still_alike(spark, sf):
    return op.still_alike(golden_compare(spark, sf), "p_partkey")


def best_floor(spark, sf):
    rows = events(spark, sf).withColumn("floor", F.explode(F.array(*map(L, (10, 20, 30, 40))))).filter("k >= floor").groupBy("series", "floor").agg(F.count_if(C("v") % 3 > 0).alias("matched"), F.count("*").alias("n_obs"))
    return _round(op.best_floor(rows.withColumn("n_ref", L(40)), "series"), "f1")


def resolve_moves(spark, sf):
    """Customers who each want the key after their own (some wrongly), in rings of four."""
    k = C("c_custkey")
    rows = table(spark, sf, "customer").select(k.alias("chart"), k.alias("key"))
    wants = rows.filter("chart % 12 < 10").select("chart", (F.floor(C("chart") / 4) * 4 + (C("chart") + 1) % 4).alias("to_key"))
    return op.resolve_moves(wants, rows)


def swap_drill(spark, sf):
    """The rule here knows each chart's key: all swaps must be restored."""
    rows = table(spark, sf, "customer").select(C("c_custkey").alias("chart"), (C("c_custkey") * 7).alias("key"))
    return op.swap_drill(rows, 20, "drill", lambda swapped: swapped.filter("key <> chart * 7").select("chart", (C("chart") * 7).alias("to_key")))


QUERIES = {
    "i1_prf": prf, "i2_pooled": pooled, "i3_compare_runs": compare_runs, "i4_component_bootstrap": component_bootstrap, "i5_leave_top_k": leave_top_k, "i6_judge": judge, "i7_components": components, "i8_hash_split": hash_split,
    "i8_balanced_halves": balanced_halves, "i9_stratify": stratify, "i10_sentinels": sentinels, "i11_regress_rule": regress_rule, "i12_null_rules": null_rules, "i13_assign_packets": assign_packets, "i14_score_agreement": score_agreement,
    "i15_identify": identify, "i16_resolve_moves": resolve_moves, "i17_swap_drill": swap_drill, "i18_percentile_bands": percentile_bands, "i19_golden_compare": golden_compare, "i19_still_alike": still_alike, "i20_best_floor": best_floor,
}

_S = "s AS (SELECT series AS chart, series // 10 AS component, count(*) FILTER (k < 60) AS m0, 2 * count(*) AS n0, count(*) FILTER (k < 60 OR v % 9 = 0) AS m1, 2 * count(*) + series % 3 AS n1 FROM events_ GROUP BY series)"
_GOLD = "w AS (SELECT p_partkey, unnest(['name', 'size']) AS field, unnest([p_name, p_size::VARCHAR]) AS want FROM part WHERE p_partkey % 4 = 0), gold AS (SELECT p_partkey, field, want, CASE WHEN p_partkey % 12 = 0 THEN NULL WHEN field = 'size' AND p_partkey % 5 = 0 THEN '99' ELSE want END AS got FROM w)"
_UNIT = "('0x' || substr(sha256({}), 1, 12))::BIGINT / 281474976710656.0"

SQL = {
    "i1_prf": f"WITH {EVENTS}, c AS (SELECT series AS chart, count(*) FILTER (k % 10 < 7) AS matched, count(*) FILTER (k % 10 IN (7, 8) AND v % 4 <> 0) AS extra, count(*) FILTER (k % 10 = 9) AS missing FROM events_ GROUP BY 1) SELECT *, round(matched / nullif(matched + missing, 0), 6) AS recall, round(matched / nullif(matched + extra, 0), 6) AS precision, round(2 * matched / nullif(2 * matched + extra + missing, 0), 6) AS f1 FROM c",
    "i2_pooled": f"WITH {EVENTS}, p AS (SELECT series, abs((v - 250) / 4000) AS e FROM events_ WHERE k % 10 < 8), n AS (SELECT series, count(*) AS o FROM events_ GROUP BY 1), t AS (SELECT unnest([0.03, 0.045, 0.06]::DOUBLE[]) AS tolerance), m AS (SELECT n.series, o, tolerance, (SELECT count(*) FROM p WHERE p.series = n.series AND e <= tolerance) AS m FROM n, t), s AS (SELECT tolerance, CAST(sum(m) AS BIGINT) AS matched, CAST(sum(o - m) AS BIGINT) AS extra, CAST(sum(o + 2 - m) AS BIGINT) AS missing, count(*) FILTER (2 * m / (2 * o + 2) >= 0.7) AS passing FROM m GROUP BY 1) SELECT *, round(matched / (matched + missing), 6) AS recall, round(matched / (matched + extra), 6) AS precision, round(2 * matched / (2 * matched + extra + missing), 6) AS f1, (SELECT round(quantile_cont(e, 0.9), 6) FROM p) AS p90 FROM s",
    "i3_compare_runs": "WITH r AS (SELECT l_orderkey AS chart, min(l_partkey) AS i, min(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey, l_linenumber), x AS (SELECT chart, i % 9 <> 0 AS hb, i % 7 <> 0 AS hc, i % 9 <> 0 AND s % 2 = 0 AS b, i % 7 <> 0 AND s % 3 = 0 AS c FROM r) SELECT chart, count(*) FILTER (b AND NOT c) AS lost, count(*) FILTER (c AND NOT b) AS gained, count(*) FILTER (NOT hc) AS removed, count(*) FILTER (NOT hc AND NOT b) AS removed_extras, count(*) FILTER (NOT hb) AS added FROM x WHERE hb OR hc GROUP BY chart",
    "i4_component_bootstrap": f"WITH {EVENTS}, {_S}, c AS (SELECT row_number() OVER (ORDER BY component) - 1 AS i, sum(m0) AS m0, sum(n0) AS n0, sum(m1) AS m1, sum(n1) AS n1 FROM s GROUP BY component), d AS (SELECT r.range AS rep, CAST(floor({_UNIT.format("7 || '|' || r.range || '|' || k.range")} * (SELECT count(*) FROM c)) AS INT) AS i FROM range(200) r, range((SELECT count(*) FROM c)) k), g AS (SELECT 2 * sum(m1) / sum(n1) - 2 * sum(m0) / sum(n0) AS g FROM d JOIN c USING (i) GROUP BY rep) SELECT (SELECT round(2 * sum(m1) / sum(n1) - 2 * sum(m0) / sum(n0), 6) FROM c) AS delta, (SELECT count(*) FROM c) AS n, round(quantile_cont(g, 0.025), 6) AS low FROM g",
    "i5_leave_top_k": f"WITH {EVENTS}, {_S}, k AS (SELECT *, row_number() OVER (ORDER BY 2 * m1 / n1 - 2 * m0 / n0 DESC, chart) AS r FROM s) SELECT round(2 * sum(m1) / sum(n1) - 2 * sum(m0) / sum(n0), 6) AS delta, count(*) AS left FROM k WHERE r > 5".replace("AS left", 'AS "left"'),
    "i6_judge": f"WITH {EVENTS}, {_S}, v AS (SELECT sum(m0)::DOUBLE AS m0, sum(m1)::DOUBLE AS m1, count(*)::DOUBLE AS c FROM s) SELECT unnest(['m0', 'm1', 'charts', 'absent']) AS name, unnest([m0, m1, c, NULL]) AS value, unnest([CASE WHEN m0 >= 100 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN m1 <= 10 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN c >= 5 THEN 'PASS' ELSE 'FAIL' END, 'N/A']) AS verdict, false AS all_pass FROM v",
    "i7_components": "WITH RECURSIVE e AS (SELECT a.p_partkey AS u, b.p_partkey AS v FROM part a JOIN part b ON a.p_size = b.p_size AND a.p_type = b.p_type AND (a.p_brand = b.p_brand OR a.p_name = b.p_name)), r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u) SELECT u AS p_partkey, min(v) AS component FROM r GROUP BY u",
    "i8_hash_split": f"WITH c AS (SELECT o_custkey AS component, bool_or(o_orderkey % 101 = 0) AS pin, {_UNIT.format("'salt|' || o_custkey")} AS u FROM orders GROUP BY o_custkey) SELECT component, CASE WHEN pin OR u < 0.5 THEN 'tune' WHEN u < 0.8 THEN 'validate' ELSE 'sealed' END AS split FROM c",
    "i8_balanced_halves": f"SELECT c_custkey, c_mktsegment, CASE WHEN row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_UNIT.format("'salt|' || c_custkey")}, c_custkey) % 2 = 1 THEN 'A' ELSE 'B' END AS half FROM customer",
    "i9_stratify": "WITH x AS (SELECT o_orderkey, o_custkey, concat_ws(',', CASE WHEN o_totalprice < 40000 THEN 'cheap' END, CASE WHEN o_orderstatus = 'O' THEN 'open' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'low' END) AS exclusions FROM orders) SELECT o_orderkey, exclusions, CASE WHEN exclusions <> '' THEN 'excluded' WHEN o_orderkey % 4 = 0 THEN 'repo_edited' WHEN o_custkey % 3 = 0 THEN 'lane_misfit' ELSE 'truth' END AS stratum FROM x",
    "i10_sentinels": f"WITH {EVENTS}, n AS (SELECT series, coalesce(t - lag(t) OVER (PARTITION BY series, k % 5 ORDER BY t) < {24 * 3_600_000_000}, false) AS j FROM events_) SELECT series, count(*) FILTER (j) AS jacks, round(count(*) FILTER (j) / count(*), 6) AS density FROM n GROUP BY series ORDER BY count(*) FILTER (j) / count(*) DESC, jacks DESC, series LIMIT 20",
    "i11_regress_rule": "WITH x AS (SELECT l_orderkey % 7 AS e, count(*) AS b, count(*) FILTER (l_returnflag <> 'R') AS v, l_orderkey % 3 AS t FROM lineitem GROUP BY l_orderkey), a AS (SELECT count(*) FILTER (b <> e AND v = e) AS fixes, count(*) FILTER (b = e AND v <> e AND t = 0) AS breaks_pristine, count(*) FILTER (b = e AND v <> e AND t = 1) AS breaks_fitted, count(*) FILTER (b = e AND v <> e AND t = 2) AS breaks_excused, count(*) FILTER (b <> e AND v <> e AND abs(v - e) < abs(b - e)) AS better, count(*) FILTER (b <> e AND v <> e AND abs(v - e) > abs(b - e)) AS worse FROM x) SELECT *, fixes - breaks_pristine - breaks_fitted AS net, fixes > 0 AND breaks_pristine = 0 AND fixes - breaks_pristine - breaks_fitted > 0 AS passes FROM a",
    "i12_null_rules": "WITH f AS (SELECT p_size % 6 AS n, p_partkey % 6 AS e, list_filter(['f3', 'f5', 'f7', 'f11', 'economy'], lambda x: CASE x WHEN 'f3' THEN p_partkey * 3 % 17 < 6 WHEN 'f5' THEN p_partkey * 5 % 17 < 6 WHEN 'f7' THEN p_partkey * 7 % 17 < 6 WHEN 'f11' THEN p_partkey * 11 % 17 < 6 ELSE p_type = 'ECONOMY' END) AS h FROM part), r AS (SELECT n, e, unnest(h) AS rule FROM f UNION ALL SELECT n, e, h[i] || '&' || h[j] FROM f, unnest(range(1, 6)) a(i), unnest(range(1, 6)) b(j) WHERE i < j AND j <= len(h)) SELECT rule, count(*) AS hits, count(*) FILTER (n <> e AND n + 1 = e) AS fixes, count(*) FILTER (n = e) AS breaks, 1 AS delta, count(*) FILTER (n <> e AND n + 1 = e) > 0 AND count(*) FILTER (n = e) = 0 AS passes FROM r GROUP BY rule",
    "i13_assign_packets": "WITH p AS (SELECT doc_id // 20 AS packet, 'real' AS kind, doc_id::VARCHAR AS item FROM documents), s AS (SELECT packet, 'seed' AS kind, (r_regionkey + 1000000)::VARCHAR AS item FROM (SELECT DISTINCT packet FROM p), region QUALIFY row_number() OVER (PARTITION BY packet ORDER BY sha256('salt|' || packet || '|' || (r_regionkey + 1000000))) <= 2), u AS (SELECT *, substr(sha256('salt|' || packet || '|' || kind || '|' || item), 1, 16) AS iid FROM (SELECT * FROM p UNION ALL SELECT * FROM s)) SELECT packet, row_number() OVER (PARTITION BY packet ORDER BY iid) AS slot, iid, kind, item FROM u",
    "i14_score_agreement": "WITH k AS (SELECT l_orderkey || '-' || l_linenumber AS item, l_orderkey AS packet, max(l_returnflag) AS a, l_linenumber = 1 AS seed, min(l_partkey) AS p FROM lineitem GROUP BY l_orderkey, l_linenumber), v AS (SELECT *, CASE WHEN p % (r * 7) = 0 THEN '?' WHEN p % (r * 5) = 0 THEN 'X' ELSE a END AS said FROM k, (SELECT unnest([2, 3, 5]) AS r) WHERE p % (r * 11) <> 0), have AS (SELECT DISTINCT packet, r FROM v), void AS (SELECT DISTINCT h.packet, h.r FROM have h JOIN k ON k.packet = h.packet AND k.seed LEFT JOIN v ON v.packet = h.packet AND v.r = h.r AND v.item = k.item WHERE v.said IS NULL OR v.said <> k.a), g AS (SELECT item, count(*) AS n, count(DISTINCT said) AS d, bool_or(said = '?') AS q, min(said) AS m FROM v ANTI JOIN void USING (packet, r) WHERE NOT seed GROUP BY item), w AS (SELECT k.packet, k.item, m, CASE WHEN coalesce(n, 0) < 2 THEN 'few_readers' WHEN d > 1 THEN 'disagree' WHEN q THEN 'unreadable' END AS why FROM k LEFT JOIN g ON k.item = g.item WHERE NOT seed) SELECT packet, item, CASE WHEN why IS NULL THEN 'AGREED' ELSE 'UNSURE' END AS verdict, CASE WHEN why IS NULL THEN m END AS answer, why FROM w",
    "i15_identify": f"WITH {EVENTS}, s AS (SELECT series, k % 6 AS c, CASE WHEN k % 6 + series % 7 <> 3 THEN count(*) % 5 / 5 END AS score, count(*) % 3 = series % 3 AS agrees, count(*) % 3 AS implied, min(k) % 4 = series % 4 AS level, k % 6 = series % 6 AS own FROM events_ GROUP BY series, k % 6), m AS (SELECT series, max(score) FILTER (own) AS mapped, coalesce(bool_or(agrees) FILTER (own), false) AS sides FROM s GROUP BY series), g AS (SELECT series, score, arg_min(c, struct_pack(a := NOT agrees, b := NOT level, c := c)) AS best, bool_or(own) AS own, count(*) AS members, count(*) FILTER (agrees) AS n, count(DISTINCT implied) AS counts FROM s WHERE score IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER w AS k, coalesce(lead(score) OVER w, 0) AS nx FROM g WINDOW w AS (PARTITION BY series ORDER BY score DESC)), t AS (SELECT r.*, mapped, sides, score - nx AS mr, CASE WHEN own THEN 0.0 ELSE score - coalesce(mapped, 0) END AS mm FROM r JOIN m ON r.series = m.series WHERE k = 1) SELECT series, best, round(score, 6) AS score, round(mr, 6) AS margin_runner, round(mm, 6) AS margin_mapped, CASE WHEN mapped IS NULL THEN 'unscored' WHEN own AND score >= 0.3 THEN 'own' WHEN own THEN 'own_low' WHEN score < 0.3 THEN 'unmatched' WHEN sides THEN 'exact_notes_disagree' WHEN mm >= 0.3 AND mr >= 0.3 THEN 'candidate' ELSE 'ambiguous' END AS status, members, CASE WHEN n = 1 OR n > 0 AND counts > 1 THEN 'count' ELSE 'twins' END AS why FROM t",
    "i18_percentile_bands": f"WITH {EVENTS}, r AS (SELECT id, kind || '/' || (series % 40) AS g, kind, v, k >= 10 AS p FROM events_), a AS (SELECT g, quantile_cont(v, 0.05) - 5 AS l, quantile_cont(v, 0.95) + 5 AS h, count(*) AS n FROM r WHERE p GROUP BY g), b AS (SELECT kind, quantile_cont(v, 0.05) - 5 AS l, quantile_cont(v, 0.95) + 5 AS h, count(*) AS n FROM r WHERE p GROUP BY kind), x AS (SELECT id, v, CASE WHEN a.n >= 15 THEN a.l WHEN b.n >= 15 THEN b.l END AS low, CASE WHEN a.n >= 15 THEN a.h WHEN b.n >= 15 THEN b.h END AS high, CASE WHEN a.n >= 15 THEN 'group' WHEN b.n >= 15 THEN 'parent' ELSE 'none' END AS source FROM r LEFT JOIN a ON r.g = a.g LEFT JOIN b ON r.kind = b.kind) SELECT id, round(low, 6) AS low, round(high, 6) AS high, source, coalesce(v < low OR v > high, false) AS outlier FROM x",
    "i19_golden_compare": f"WITH {_GOLD} SELECT *, want IS NOT DISTINCT FROM got AS same FROM gold",
    "i19_still_alike": f"WITH {_GOLD}, e AS (SELECT bool_and(want IS NOT DISTINCT FROM got) AS s FROM gold GROUP BY p_partkey) SELECT count(*) FILTER (s) AS alike, count(*) AS total FROM e",
    "i20_best_floor": f"WITH {EVENTS}, f AS (SELECT series, fl AS floor, count(*) FILTER (v % 3 > 0) AS m, count(*) AS n FROM events_, (SELECT unnest([10, 20, 30, 40]) AS fl) WHERE k >= fl GROUP BY ALL HAVING count(*) >= 15) SELECT series, floor, round(2 * m / (n + 40), 6) AS f1 FROM f QUALIFY row_number() OVER (PARTITION BY series ORDER BY round(2 * m / (n + 40), 9) DESC, floor) = 1",
}
