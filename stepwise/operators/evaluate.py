"""Evaluation: scores, bootstraps, splits, agreement, identification and negative controls.

Nothing here draws random numbers: every draw and split is a hash of a seed or salt and
an id, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import norm_answer
from ._range import numbered
from .components import connected


def hash_unit(*parts: Column, digits: int = 12) -> Column:
    """A number in [0, 1) from the first hex digits of the sha256 of the parts, joined by '|'."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *(p.cast("string") for p in parts)), 256), 1, digits), 16, 10).cast("double") / float(16**digits)


def prf(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, matched, extra, missing, recall, precision, f1 from rows(by, kind, fake): extras that are drawn fakes leave the precision's denominator."""
    kind = F.col("kind")
    m, x, n = F.count_if(kind == "pair"), F.count_if((kind == "extra") & ~F.coalesce("fake", F.lit(False))), F.count_if(kind == "missing")
    return with_scores(rows.groupBy(*by).agg(m.alias("matched"), x.alias("extra"), n.alias("missing")))


def with_scores(counts: DataFrame) -> DataFrame:
    """counts(matched, extra, missing) with recall, precision and f1 (null where undefined)."""
    ratio = lambda a, b: F.when(b > 0, a / b)
    m, x, n = F.col("matched"), F.col("extra"), F.col("missing")
    return counts.withColumn("recall", ratio(m, m + n)).withColumn("precision", ratio(m, m + x)).withColumn("f1", ratio(2 * m, 2 * m + x + n))


def pooled(pairs: DataFrame, totals: DataFrame, tolerances: Sequence[float], bar: float = 0.95) -> DataFrame:
    """tolerance, matched, extra, missing, recall, precision, f1, p90, passing: micro-pooled over charts at each tolerance.

    pairs(chart, error), totals(chart, n_obs, n_ref). p90 of |error| over all pairs; passing: charts
    whose own f1 reaches the bar.
    """
    rows = pairs.select("chart", F.abs("error").alias("e"), F.explode(F.array(*map(F.lit, tolerances))).alias("tolerance")).groupBy("chart", "tolerance").agg(F.count_if(F.col("e") <= F.col("tolerance")).alias("matched"))
    grid = totals.select("chart", "n_obs", "n_ref", F.explode(F.array(*map(F.lit, tolerances))).alias("tolerance")).join(rows, ["chart", "tolerance"], "left").withColumn("matched", F.coalesce("matched", F.lit(0)))
    f1 = 2 * F.col("matched") / (F.col("n_obs") + F.col("n_ref"))
    out = grid.groupBy("tolerance").agg(F.sum("matched").alias("matched"), F.sum(F.col("n_obs") - F.col("matched")).alias("extra"), F.sum(F.col("n_ref") - F.col("matched")).alias("missing"), F.count_if(f1 >= bar).alias("passing"))
    p90 = pairs.agg(F.percentile(F.abs("error"), F.lit(0.9)).alias("p90"))
    return with_scores(out).crossJoin(p90)  # one row


def compare_runs(base: DataFrame, cand: DataFrame) -> DataFrame:
    """chart, lost, gained, removed, removed_extras, added: of two runs' notes(chart, col, idx, matched)."""
    b, c = base.select("chart", "col", "idx", F.col("matched").alias("_b")), cand.select("chart", "col", "idx", F.col("matched").alias("_c"))
    both = b.join(c, ["chart", "col", "idx"], "full_outer")
    on = lambda x: F.coalesce(x, F.lit(False))
    return both.groupBy("chart").agg(
        F.count_if(on("_b") & ~on("_c")).alias("lost"), F.count_if(~on("_b") & on("_c")).alias("gained"), F.count_if(F.col("_c").isNull()).alias("removed"),
        F.count_if(F.col("_c").isNull() & ~on("_b")).alias("removed_extras"), F.count_if(F.col("_b").isNull()).alias("added"),
    )


def component_bootstrap(per: DataFrame, reps: int, seed: int, q: float = 0.025) -> DataFrame:
    """delta, low, n: the pooled gain in f1, and its q-quantile over resamples of whole components.

    per(component, m0, n0, m1, n1): matches and the sum of both sides' notes, before and after.
    A draw is a hash of (seed, rep, draw) modulo the number of components; the draws of a
    repetition are counted by component before they meet the sums.
    """
    sums = per.groupBy("component").agg(*(F.sum(c).alias(c) for c in ("m0", "n0", "m1", "n1")))
    places = numbered(sums, ["component"], "i").checkpoint()
    n = places.count()
    draws = per.sparkSession.range(reps * n).select(F.floor(F.col("id") / n).alias("rep"), (F.col("id") % n).alias("k"))
    picks = draws.withColumn("i", F.floor(hash_unit(F.lit(seed), F.col("rep"), F.col("k")) * n).cast("long")).groupBy("rep", "i").agg(F.count("*").alias("w"))
    gain = 2 * F.sum(F.col("w") * F.col("m1")) / F.sum(F.col("w") * F.col("n1")) - 2 * F.sum(F.col("w") * F.col("m0")) / F.sum(F.col("w") * F.col("n0"))
    each = picks.join(places, "i").groupBy("rep").agg(gain.alias("gain"))
    whole = sums.agg((2 * F.sum("m1") / F.sum("n1") - 2 * F.sum("m0") / F.sum("n0")).alias("delta"), F.count("*").alias("n"))
    return whole.crossJoin(each.agg(F.percentile("gain", F.lit(q)).alias("low")))  # one row each


def leave_top_k(per: DataFrame, k: int) -> DataFrame:
    """delta, left: the pooled gain in f1 without the k charts that gain most (per(chart, m0, n0, m1, n1); ties: the smaller chart)."""
    gain = 2 * F.col("m1") / F.col("n1") - 2 * F.col("m0") / F.col("n0")
    top = per.select("chart", gain.alias("g")).orderBy(F.desc("g"), "chart").limit(k)  # the feature itself: k rows
    rest = per.join(F.broadcast(top.select("chart")), "chart", "left_anti")
    return rest.agg((2 * F.sum("m1") / F.sum("n1") - 2 * F.sum("m0") / F.sum("n0")).alias("delta"), F.count("*").alias("left"))


def judge(summary: DataFrame, criteria: DataFrame) -> DataFrame:
    """name, value, verdict (PASS, FAIL, N/A), all_pass: criteria(name, op, bound) against summary(name, value)."""
    v, b, op = F.col("value"), F.col("bound"), F.col("op")
    ok = F.when(op == ">=", v >= b).when(op == "<=", v <= b).when(op == "=", v == b)
    rows = criteria.join(summary, "name", "left").withColumn("verdict", F.when(v.isNull() | ok.isNull(), "N/A").when(ok, "PASS").otherwise("FAIL"))
    whole = F.min(F.col("verdict") == "PASS").over(Window.partitionBy(F.lit(1)))  # a criteria table has a few rows
    return rows.select("name", "value", "verdict", whole.alias("all_pass"))


def components(df: DataFrame, node: str, keys: Sequence[str]) -> DataFrame:
    """node, component (the smallest node): nodes that share a value of any key column, transitively; null shares with none.

    Each value links its nodes to the smallest of them, so a value that very many share makes a star, not pairs.
    """
    edges = None
    for key in keys:
        rows = df.filter(F.col(key).isNotNull()).select(F.col(node).alias("u"), F.col(key).alias("_k"))
        part = rows.join(rows.groupBy("_k").agg(F.min("u").alias("v")), "_k").select("u", "v")
        edges = part if edges is None else edges.unionByName(part)
    found = connected(edges)
    return df.select(node).distinct().join(found.withColumnRenamed("node", node), node, "left").withColumn("component", F.coalesce("component", node))


def hash_split(members: DataFrame, salt: str, shares: Mapping[str, float], pinned: str = "tune") -> DataFrame:
    """component, split: by the hash of salt and component; components with a pinned member go to `pinned`. members(component, pin)."""
    rows = members.groupBy("component").agg(F.max(F.coalesce("pin", F.lit(False))).alias("_pin")).withColumn("_u", hash_unit(F.lit(salt), F.col("component")))
    split, edge = F.lit(list(shares)[-1]), 1.0
    for name, share in reversed(list(shares.items())[:-1]):
        edge = sum(list(shares.values())[: list(shares).index(name) + 1])
        split = F.when(F.col("_u") < edge, name).otherwise(split)
    return rows.select("component", F.when(F.col("_pin"), pinned).otherwise(split).alias("split"))


def balanced_halves(rows: DataFrame, stratum: Sequence[str], salt: str, item: str = "component") -> DataFrame:
    """rows with half (A, B): the hash's order within each stratum, alternating, so that halves differ by one at most."""
    order = Window.partitionBy(*stratum).orderBy(hash_unit(F.lit(salt), F.col(item)), item)
    return rows.withColumn("half", F.when(F.row_number().over(order) % 2 == 1, "A").otherwise("B"))


def stratify(rows: DataFrame, rules: Sequence[tuple[str, Column]], edited: Column, misfit: Column) -> DataFrame:
    """rows with exclusions (all reasons that hold) and stratum: excluded, repo_edited, lane_misfit or truth."""
    reasons = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), name) for name, c in rules)))
    stratum = F.when(F.size("exclusions") > 0, "excluded").when(edited, "repo_edited").when(misfit, "lane_misfit").otherwise("truth")
    return rows.withColumn("exclusions", reasons).withColumn("stratum", stratum)


def sentinels(notes: DataFrame, by: str, n: int, jack: float = 0.25) -> DataFrame:
    """by, jacks, density: the n series with the largest share of jacks (a note less than `jack` after the last in its column); ties: more jacks, then the name."""
    order = Window.partitionBy(by, "col").orderBy("t")
    rows = notes.withColumn("_j", F.coalesce(F.col("t") - F.lag("t").over(order) < jack, F.lit(False)))
    out = rows.groupBy(by).agg(F.count_if("_j").alias("jacks"), F.count("*").alias("_n")).withColumn("density", F.col("jacks") / F.col("_n"))
    return out.select(by, "jacks", "density").orderBy(F.desc("density"), F.desc("jacks"), by).limit(n)  # a top-n report


def regress_rule(base: DataFrame, variant: DataFrame, tiers: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """One row: fixes, breaks by tier (pristine, fitted, excused), better, worse, net, passes.

    base and variant(block, n), tiers(block, expected, tier). better and worse: nearer to
    or further from the expected count without reaching or leaving it. passes: some fix,
    no pristine break, net above 0.
    """
    rows = tiers.join(base.select("block", F.col("n").alias("_b")), "block").join(variant.select("block", F.col("n").alias("_v")), "block")
    e, b, v = F.col("expected"), F.col("_b"), F.col("_v")
    was, now = b == e, v == e
    out = rows.agg(
        F.count_if(~was & now).alias("fixes"), *(F.count_if(was & ~now & (F.col("tier") == t)).alias(f"breaks_{t}") for t in ("pristine", "fitted", "excused")),
        F.count_if(~was & ~now & (F.abs(v - e) < F.abs(b - e))).alias("better"), F.count_if(~was & ~now & (F.abs(v - e) > F.abs(b - e))).alias("worse"),
    )
    net = F.col("fixes") - F.col("breaks_pristine") - F.col("breaks_fitted")
    return out.withColumn("net", net).withColumn("passes", (F.col("fixes") > 0) & (F.col("breaks_pristine") == 0) & (net > 0))


def null_rules(features: DataFrame, names: Sequence[str], delta: int, arity: int = 2) -> DataFrame:
    """rule, delta, hits, fixes, breaks, passes: every predicate of one or two true feature columns, adding delta where it holds.

    features(n, expected, names...). Each row is unpivoted to the predicates that hold for
    it (at most names + pairs of names), then counted once for each rule.
    """
    singles = [(F.col(a), a) for a in names]
    pairs = [(F.col(a) & F.col(b), f"{a}&{b}") for i, a in enumerate(names) for b in names[i + 1 :]] if arity > 1 else []
    held = F.array_compact(F.array(*(F.when(c, name) for c, name in singles + pairs)))
    rows = features.select("n", "expected", F.explode(held).alias("rule"))
    was, now = F.col("n") == F.col("expected"), F.col("n") + delta == F.col("expected")
    out = rows.groupBy("rule").agg(F.count("*").alias("hits"), F.count_if(~was & now).alias("fixes"), F.count_if(was & ~now).alias("breaks"))
    return out.withColumn("delta", F.lit(delta)).withColumn("passes", (F.col("fixes") > 0) & (F.col("breaks") == 0))


def assign_packets(items: DataFrame, seeds: DataFrame, size: int, share: float, salt: str) -> DataFrame:
    """packet, slot, iid, kind, item: items in order, `size` to a packet, each packet with ceil(share * size) seeds of its own, shuffled; ids tell nothing.

    items(item, pos) with pos from 0 without gaps; seeds(seed). A packet's seeds are those
    that a hash of salt and packet ranks first, so none repeats in a packet.
    """
    want = -(-int(round(share * size * 1000)) // 1000)
    real = items.select(F.floor(F.col("pos") / size).alias("packet"), F.lit("real").alias("kind"), F.col("item").cast("string").alias("item"))
    packets = real.select("packet").distinct()
    ranked = packets.crossJoin(F.broadcast(seeds)).withColumn("_r", F.row_number().over(Window.partitionBy("packet").orderBy(F.sha2(F.concat_ws("|", F.lit(salt), F.col("packet").cast("string"), F.col("seed").cast("string")), 256))))  # seeds: a small hand-made table
    chosen = ranked.filter(F.col("_r") <= want).select("packet", F.lit("seed").alias("kind"), F.col("seed").cast("string").alias("item"))
    rows = real.unionByName(chosen).withColumn("iid", F.substring(F.sha2(F.concat_ws("|", F.lit(salt), F.col("packet").cast("string"), F.col("kind"), F.col("item")), 256), 1, 16))
    return rows.withColumn("slot", F.row_number().over(Window.partitionBy("packet").orderBy("iid")))


def score_agreement(keys: DataFrame, answers: DataFrame) -> DataFrame:
    """packet, item, verdict, answer, why: AGREED where at least two valid readers give one answer without '?', else UNSURE with few_readers, disagree or unreadable.

    keys(packet, item, kind, answer), answers(reader, packet, item, answer); answers are normalised. A reader who
    answers anything in a packet has it; a seed of it answered wrongly, or not at all, makes
    the reader void there. A packet without seeds voids nobody. Empty answers aren't votes.
    """
    said = answers.select("reader", "packet", "item", norm_answer(F.col("answer")).alias("_said"))
    seeds = keys.filter("kind = 'seed'").select("packet", "item", norm_answer(F.col("answer")).alias("_want"))
    asked = said.select("reader", "packet").distinct().join(seeds, "packet").select("packet", "reader", "item", F.lit(True).alias("_seed"), "_want", F.lit(None).cast("string").alias("_said"))
    every = asked.unionByName(said.select("packet", "reader", "item", F.lit(False).alias("_seed"), F.lit(None).cast("string").alias("_want"), "_said"))
    vote = F.when(F.col("_said") != "", F.col("_said"))
    each = every.groupBy("packet", "reader", "item").agg(
        F.count_if("_seed").alias("_seeds"), F.count("_want").alias("_wants"), F.min("_want").alias("_w0"), F.max("_want").alias("_w1"), F.count_if(~F.col("_seed")).alias("_rows"), F.count("_said").alias("_answers"), F.min("_said").alias("_s0"), F.max("_said").alias("_s1"),
        F.count(vote).alias("_n"), F.min(vote).alias("_lo"), F.max(vote).alias("_hi"), F.max(vote.contains("?")).alias("_q"),
    )
    known = F.col("reader").isNotNull() & F.col("item").isNotNull()
    right = F.when(F.col("_wants") == 0, ~known | (F.col("_answers") == 0)).otherwise(known & (F.col("_wants") == F.col("_seeds")) & (F.col("_rows") > 0) & (F.col("_answers") == F.col("_rows")) & (F.col("_w0") == F.col("_w1")) & (F.col("_s0") == F.col("_s1")) & (F.col("_w0") == F.col("_s0")))
    wrong = (F.col("_seeds") > 0) & ~F.coalesce(right, F.lit(False))
    void = F.max(wrong).over(Window.partitionBy("packet", "reader")) & F.col("reader").isNotNull()
    votes = each.withColumn("_void", void).filter("NOT _void AND _n > 0 AND packet IS NOT NULL AND item IS NOT NULL").select("packet", "item", "_n", "_lo", "_hi", "_q", F.lit(False).alias("_real"))
    real = keys.filter("kind = 'real'").select("packet", "item", F.lit(0).cast("long").alias("_n"), *(F.lit(None).cast("string").alias(c) for c in ("_lo", "_hi")), F.lit(None).cast("boolean").alias("_q"), F.lit(True).alias("_real"))
    got = votes.unionByName(real).groupBy("packet", "item").agg(F.max("_real").alias("_real"), F.sum("_n").alias("_n"), F.min("_lo").alias("answer"), F.max("_hi").alias("_hi"), F.max("_q").alias("_q")).filter("_real")
    why = F.when(F.col("_n") < 2, "few_readers").when(F.col("answer") != F.col("_hi"), "disagree").when(F.col("_q"), "unreadable")
    return got.select("packet", "item", F.when(why.isNull(), "AGREED").otherwise("UNSURE").alias("verdict"), F.when(why.isNull(), F.col("answer")).alias("answer"), why.alias("why"))


def identify(scores: DataFrame, least: float, margin: float) -> DataFrame:
    """series, best, score, margin_runner, margin_mapped, status, members, why: which candidate a series is.

    scores(series, candidate, own: is it the mapped one, implied, expected, level, wanted, place, score): expected and
    wanted (the count and level known of the series) are one a series. Candidates of one score and signature (here: the
    score) are one group; the runner-up is the next group, 0 if there is none. status: own if the mapped one is in the best
    group, own_low if that is under `least`; unscored if the mapped one has no score; unmatched if the best is under `least`;
    exact_notes_disagree if the mapped one's count is the expected one; candidate if the best is ahead of the runner-up and of
    the mapped one by `margin`; else ambiguous. The member named has the expected count, if counts differ; then the wanted
    level; then the first place.
    """
    mapped = scores.groupBy("series").agg(F.max(F.when(F.col("own"), F.col("score"))).alias("_mapped"), F.max(F.when(F.col("own"), F.coalesce(F.col("implied") == F.col("expected"), F.lit(False)))).alias("_sides"))
    agrees = F.coalesce(F.col("implied") == F.col("expected"), F.lit(False))
    rank = F.struct((~agrees).alias("a"), (~F.coalesce(F.col("level") == F.col("wanted"), F.lit(False))).alias("l"), "place", "candidate")
    groups = scores.filter("score IS NOT NULL").groupBy("series", "score").agg(F.min_by("candidate", rank).alias("best"), F.max("own").alias("own"), F.count("*").alias("members"), F.max(agrees).alias("_agrees"), F.countDistinct("implied").alias("_counts"), F.count_if(agrees).alias("_n"))
    order = Window.partitionBy("series").orderBy(F.desc("score"))
    top = groups.withColumn("_k", F.row_number().over(order)).withColumn("_next", F.coalesce(F.lead("score").over(order), F.lit(0.0))).filter("_k = 1").join(mapped, "series")
    runner = F.col("score") - F.col("_next")
    behind = F.when(F.col("own"), 0.0).otherwise(F.col("score") - F.coalesce("_mapped", F.lit(0.0)))
    status = (
        F.when(F.col("_mapped").isNull(), "unscored").when(F.col("own"), F.when(F.col("score") >= least, "own").otherwise("own_low")).when(F.col("score") < least, "unmatched")
        .when(F.col("_sides"), "exact_notes_disagree").when((behind >= margin) & (runner >= margin), "candidate").otherwise("ambiguous")
    )
    why = F.when((F.col("_n") == 1) | (F.col("_agrees") & (F.col("_counts") > 1)), "count").otherwise("twins")
    return top.select("series", "best", "score", runner.alias("margin_runner"), behind.alias("margin_mapped"), status.alias("status"), "members", why.alias("why"))


def passes_agree(found: DataFrame, by: str = "series") -> DataFrame:
    """by, best, status: what several passes over one series (rows of identify with a column of passes) come to; passes_disagree where they name different candidates."""
    each = found.filter("status IN ('candidate', 'own')").groupBy(by).agg(F.countDistinct("best").alias("_d"), F.min("best").alias("best"), F.min("status").alias("status"))
    return each.select(by, F.when(F.col("_d") == 1, F.col("best")).alias("best"), F.when(F.col("_d") == 1, F.col("status")).otherwise("passes_disagree").alias("status"))


def resolve_moves(proposals: DataFrame, mapping: DataFrame) -> DataFrame:
    """chart, to_key, state: moved or stuck, for proposals(chart, to_key) against mapping(chart, key).

    Two names may not end on one key; a move waits for its key's holder to move away, and is
    stuck if the holder stays. Rings of movers move together. Rounds end when no more get stuck.
    """
    wanted = proposals.groupBy("to_key").agg(F.count("*").alias("_n"))
    rows = proposals.join(wanted, "to_key").join(mapping.select(F.col("key").alias("to_key"), F.col("chart").alias("_holder")), "to_key", "left")
    rows = rows.filter("_holder IS NULL OR _holder <> chart").select("chart", "to_key", "_holder", (F.col("_n") > 1).alias("stuck")).checkpoint()
    while True:
        moving = rows.filter("NOT stuck").select(F.col("chart").alias("_holder"), F.lit(True).alias("_goes"))
        new = rows.join(moving, "_holder", "left").select("chart", "to_key", "_holder", (F.col("stuck") | (F.col("_holder").isNotNull() & F.col("_goes").isNull())).alias("stuck")).checkpoint()
        if new.filter("stuck").count() == rows.filter("stuck").count():
            break
        rows = new
    return new.select("chart", "to_key", F.when(F.col("stuck"), "stuck").otherwise("moved").alias("state"))


def swap_drill(mapping: DataFrame, n: int, seed: str, rule: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """chart, swapped_to, restored: n pairs of charts (ranked by hash) swap keys; rule(swapped mapping) gives proposals(chart, to_key) and must restore them."""
    order = Window.orderBy(hash_unit(F.lit(seed), F.col("chart")), "chart")
    few = mapping.orderBy(hash_unit(F.lit(seed), F.col("chart")), "chart").limit(2 * n)  # the drill's size is n
    numbered = few.withColumn("_i", F.row_number().over(order) - 1)
    other = numbered.select((F.col("_i") + 1 - 2 * (F.col("_i") % 2)).alias("_i"), F.col("key").alias("_key"))
    swaps = numbered.join(other, "_i").select("chart", F.col("_key").alias("swapped_to")).checkpoint()
    swapped = mapping.join(swaps, "chart", "left").select("chart", F.coalesce("swapped_to", "key").alias("key"))
    moves = resolve_moves(rule(swapped), swapped).filter("state = 'moved'").select("chart", F.col("to_key").alias("_to"))
    back = swaps.join(moves, "chart", "left").join(mapping.select("chart", F.col("key").alias("_was")), "chart")
    return back.select("chart", "swapped_to", F.coalesce(F.col("_to") == F.col("_was"), F.lit(False)).alias("restored"))


def percentile_bands(fits: DataFrame, group: str, parent: str, value: str, least: int, pad: float, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """fits with low, high, source, outlier: the band of its group's passing fits; pooled over the parent where the group has under `least`, none where that has too.

    fits(group, parent, value, passes).
    """
    good = fits.filter("passes")
    band = lambda key, tag: good.groupBy(key).agg((F.percentile(value, F.lit(lo)) - pad).alias(f"_l{tag}"), (F.percentile(value, F.lit(hi)) + pad).alias(f"_h{tag}"), F.count("*").alias(f"_n{tag}"))
    rows = fits.join(band(group, "g"), group, "left").join(band(parent, "p"), parent, "left")
    own, pool = F.coalesce(F.col("_ng") >= least, F.lit(False)), F.coalesce(F.col("_np") >= least, F.lit(False))
    pick = lambda g, p: F.when(own, F.col(g)).when(pool, F.col(p))
    out = rows.withColumn("low", pick("_lg", "_lp")).withColumn("high", pick("_hg", "_hp")).withColumn("source", F.when(own, "group").when(pool, "parent").otherwise("none"))
    return out.withColumn("outlier", F.coalesce((F.col(value) < F.col("low")) | (F.col(value) > F.col("high")), F.lit(False))).select(*fits.columns, "low", "high", "source", "outlier")


def golden_compare(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """key, field, want, got, same: only the fields that expected(key, field, value) records; a missing one is null."""
    rows = expected.select(key, "field", F.col("value").alias("want")).join(got.select(key, "field", F.col("value").alias("got")), [key, "field"], "left")
    return rows.withColumn("same", F.col("want").eqNullSafe(F.col("got")))


def still_alike(compared: DataFrame, key: str) -> DataFrame:
    """alike, total: how many keys have all their recorded fields as they were."""
    each = compared.groupBy(key).agg(F.min("same").alias("_s"))
    return each.agg(F.count_if("_s").alias("alike"), F.count("*").alias("total"))


def best_floor(candidates: DataFrame, by: str, least: int = 15) -> DataFrame:
    """by, floor, f1: of candidates(by, floor, matched, n_obs, n_ref), the floor with the best agreement, among those with at least `least` observations (ties: the lowest floor)."""
    f1 = 2 * F.col("matched") / (F.col("n_obs") + F.col("n_ref"))
    rows = candidates.filter(F.col("n_obs") >= least).withColumn("f1", f1)
    return rows.groupBy(by).agg(F.max_by(F.struct("floor", "f1"), F.struct(F.round("f1", 9), -F.col("floor"))).alias("_b")).select(by, "_b.floor", "_b.f1")
