"""Ledgers, versions, gates and release checks.

All are joins on keys and case expressions; loops to a fixpoint run on small deltas
(overlay rows), never on the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge_ledgers(ledgers: Sequence[DataFrame], key: str, fields: Sequence[str], present: str = "present") -> DataFrame:
    """key, fields: each field from the last ledger that has it.

    Ledgers come in order of precedence, the last wins. present is an array of the fields
    that a row has: an absent field keeps an earlier value, a null that is present wins.
    """
    rows = None
    for rank, ledger in enumerate(ledgers):
        part = ledger.select(key, present, *fields, F.lit(rank).alias("_rank"))
        rows = part if rows is None else rows.unionByName(part)
    has = lambda f: F.array_contains(present, f)
    return rows.groupBy(key).agg(*(F.max(F.when(has(f), F.struct("_rank", F.col(f).alias("v")))).alias(f"_{f}") for f in fields)).select(key, *(F.col(f"_{f}.v").alias(f) for f in fields))


def merge_nested(ledgers: Sequence[DataFrame], key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """key, fields: the rows of all ledgers (such as charts of a video), the last ledger's where several have one."""
    rows = None
    for rank, ledger in enumerate(ledgers):
        part = ledger.select(*key, F.struct(F.lit(rank).alias("r"), *fields).alias("_s"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(*key).agg(F.max("_s").alias("_s")).select(*key, *(F.col(f"_s.{f}").alias(f) for f in fields))


def overlay_rekey(mapping: DataFrame, moves: DataFrame) -> DataFrame:
    """mapping(chart, key, file) with the moves(chart, from_key, to_key, file) applied whose key and file are the row's own.

    Never two charts on one key: movers are taken back until no key clashes. Movers are
    few; each round only looks at them and at the keys that they touch.
    """
    rows = mapping.join(moves.select("chart", F.col("from_key").alias("_from"), F.col("to_key").alias("_to"), F.col("file").alias("_file")), "chart", "left")
    live = rows.withColumn("_moves", F.coalesce((F.col("_from") == F.col("key")) & (F.col("_file") == F.col("file")), F.lit(False)))
    movers = live.filter("_moves").select("chart", F.col("key").alias("old"), F.col("_to").alias("new")).checkpoint()
    while True:
        wanted = movers.groupBy("new").agg(F.count("*").alias("_n"))
        holders = mapping.join(movers.select("chart"), "chart", "left_anti").select(F.col("key").alias("new"), F.lit(True).alias("_held"))
        clash = movers.join(wanted, "new").join(holders.join(movers.select("new").distinct(), "new", "left_semi").distinct(), "new", "left").filter("_n > 1 OR _held").select("chart")
        left = movers.join(clash, "chart", "left_anti").checkpoint()
        if left.count() == movers.count():
            break
        movers = left
    final = mapping.join(movers.select("chart", "new"), "chart", "left")
    return final.select("chart", F.coalesce("new", "key").alias("key"), "file", F.col("new").isNotNull().alias("moved"))


def overlay_withdraw(cert: DataFrame, rows: DataFrame) -> DataFrame:
    """cert without the charts that rows(vid, chart, side) withdraw; a row whose side differs does nothing."""
    return cert.join(rows.select("vid", "chart", "side"), ["vid", "chart", "side"], "left_anti")


def population(cert: DataFrame, mapping: DataFrame, census: DataFrame, sweep: DataFrame) -> DataFrame:
    """chart, vid, expected: certified and mapped charts; the count of the certification, else census, else sweep; of several videos the last by seq (ties: the greatest vid).

    cert(vid, chart, status, expected, seq), mapping(chart), census(chart, count), sweep(chart, count).
    """
    rows = cert.filter("status = 'CERTIFIED'").join(mapping.select("chart").distinct(), "chart", "left_semi")
    last = rows.groupBy("chart").agg(F.max_by(F.struct("vid", "expected"), F.struct("seq", "vid")).alias("_b"))
    last = last.join(census.select("chart", F.col("count").alias("_c")), "chart", "left").join(sweep.select("chart", F.col("count").alias("_s")), "chart", "left")
    return last.select("chart", "_b.vid", F.coalesce("_b.expected", "_c", "_s").alias("expected"))


def append_only(before: DataFrame, after: DataFrame, by: Sequence[str] = ("ledger",)) -> DataFrame:
    """ledger, ok, first_bad: every line(ledger, pos, line) of before stands unchanged at its place in after."""
    both = before.select(*by, "pos", F.col("line").alias("_a")).join(after.select(*by, "pos", F.col("line").alias("_b")), [*by, "pos"], "left")
    bad = F.min(F.when(~F.col("_a").eqNullSafe(F.col("_b")), F.col("pos")))
    return both.groupBy(*by).agg(bad.alias("first_bad")).select(*by, F.col("first_bad").isNull().alias("ok"), "first_bad")


def verify_chain(ledger: DataFrame, by: Sequence[str] = ("ledger",), genesis: str = "0" * 64) -> DataFrame:
    """ledger, n, first_break, reason: prev must be the hash before (64 zeros at the start), and hash the sha256 of prev and body.

    ledger(ledger, seq, body, prev, hash).
    """
    order = Window.partitionBy(*by).orderBy("seq")
    want = F.coalesce(F.lag("hash").over(order), F.lit(genesis))
    reason = F.when(F.col("prev") != want, "prev").when(F.sha2(F.concat("prev", "body"), 256) != F.col("hash"), "hash")
    rows = ledger.withColumn("_r", reason)
    first = F.min(F.when(F.col("_r").isNotNull(), F.struct("seq", "_r")))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), first.alias("_f")).select(*by, "n", F.col("_f.seq").alias("first_break"), F.col("_f._r").alias("reason"))


def well_formed(rows: DataFrame, kind: str) -> DataFrame:
    """The demotions (chart, block_sha of 64 hex digits, reason and evidence not blank) or promotions (audit FLAT and covered) that count."""
    said = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) > 0
    sha = F.col("chart").isNotNull() & F.coalesce(F.col("block_sha").rlike("^[0-9a-f]{64}$"), F.lit(False))
    return rows.filter(sha & said("reason") & said("evidence")) if kind == "demotion" else rows.filter(sha & (F.col("audit") == "FLAT") & F.col("covered"))


def assign_tiers(rows: DataFrame, import_exact: DataFrame, demotions: DataFrame, promotions: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """rows(chart, block_sha, exact, ...) with protected_by, tier and flags.

    A block is protected by its promotion, unless that very block is demoted; else by the
    import, where it was exact (import_exact(chart)), unless any block of the chart is demoted.
    tier: PROTECTED; else PROVISIONAL if exact; else null. flags: demoted, and those of
    flagged(chart, flag): oracle_conflict, owner_revisit, quarantine.
    """
    down, up = well_formed(demotions, "demotion"), well_formed(promotions, "promotion")
    mark = lambda df, name, *key: df.select(*key, F.lit(True).alias(name)).distinct()
    out = rows.join(mark(import_exact, "_imported", "chart"), "chart", "left").join(mark(down, "_chart_down", "chart"), "chart", "left")
    out = out.join(mark(down, "_down", "chart", "block_sha"), ["chart", "block_sha"], "left").join(mark(up, "_up", "chart", "block_sha"), ["chart", "block_sha"], "left")
    on = lambda c: F.coalesce(c, F.lit(False))
    by = F.when(on("_up") & ~on("_down"), "promotion").when(on("_imported") & ~on("_chart_down"), "import")
    flags = F.array_compact(F.array(F.when(on("_chart_down"), "demoted")))
    if flagged is not None:
        out = out.join(flagged.groupBy("chart").agg(F.collect_set("flag").alias("_flags")), "chart", "left")
        flags = F.concat(flags, F.array_sort(F.coalesce("_flags", F.array().cast("array<string>"))))
    out = out.withColumn("protected_by", by).withColumn("tier", F.when(by.isNotNull(), "PROTECTED").when(F.col("exact"), "PROVISIONAL")).withColumn("flags", flags)
    return out.select(*rows.columns, "protected_by", "tier", "flags")


def gate(base: DataFrame, head: DataFrame, demotions: DataFrame, promotions: DataFrame | None = None, flagged: DataFrame | None = None, oracle_changed: bool = False) -> DataFrame:
    """chart, transition, tier_base, tier_head, fails, audit: each chart that two versions differ in, why that fails (null: it doesn't), and against what its change is to be audited.

    base and head (chart, exact, block_sha, header_sha, expected, tier, protected_by);
    demotions(chart, block_sha, reason, evidence, owner, added: is the row new in head), of
    both versions; promotions(chart, block_sha, audit, covered) of head; flagged(chart, flag)
    of either. transition is the first that holds of

    LOST, LEFT-EXACT: exact before, not after (LEFT-: gone). Fails for a protected chart
        always; else without a demotion of the block it had; else in quarantine, if the owner hasn't signed that.
    GAINED, ENTERED-EXACT: exact after, not before (ENTERED-: new). Fails in oracle_conflict.
    EDITED-EXACT: exact before and after, its block or header changed. Fails for a protected
        chart, unless the new block is promoted under the same header.
    EDITED-OFF, EXPECTED-CHANGED, ENTERED, LEFT: never fail.
    UNPROTECTED: protected before only. Needs a demotion of its block, or a new one of the chart
        (signed in quarantine), unless the oracle changed.
    PROMOTED: protected after only.

    Demotions that head adds without an owner are rows of their own (transition LEDGER).
    """
    none = lambda schema: base.sparkSession.createDataFrame([], schema)
    promotions = none("chart string, block_sha string, audit string, covered boolean") if promotions is None else promotions
    flagged = none("chart string, flag string") if flagged is None else flagged
    down = well_formed(demotions, "demotion").withColumn("_signed", F.length(F.trim(F.coalesce("owner", F.lit("")))) > 0)
    of_block = down.groupBy("chart", "block_sha").agg(F.min_by("_signed", F.struct("reason", "evidence")).alias("_block"))
    fresh = down.filter("added").groupBy("chart").agg(F.min_by("_signed", F.struct("block_sha", "reason")).alias("_fresh"))
    up = well_formed(promotions, "promotion").select("chart", F.col("block_sha").alias("_up_sha"), F.lit(True).alias("_up")).distinct()
    flags = flagged.groupBy("chart").agg(F.max(F.col("flag") == "oracle_conflict").alias("_conflict"), F.max(F.col("flag") == "quarantine").alias("_quarantine"))
    side = lambda df, n: df.select("chart", F.struct("exact", "block_sha", "header_sha", "expected", "tier", "protected_by").alias(n))
    rows = side(base, "b").join(side(head, "h"), "chart", "full_outer")
    rows = rows.withColumn("block_sha", F.col("b.block_sha")).join(of_block, ["chart", "block_sha"], "left").join(fresh, "chart", "left").join(flags, "chart", "left")
    rows = rows.withColumn("_up_sha", F.col("h.block_sha")).join(up, ["chart", "_up_sha"], "left")

    on = lambda c: F.coalesce(c, F.lit(False))
    b, h = F.col("b"), F.col("h")
    both, exact_b, exact_h = b.isNotNull() & h.isNotNull(), on(b["exact"]), on(h["exact"])
    edited = both & ~(b["block_sha"].eqNullSafe(h["block_sha"]) & b["header_sha"].eqNullSafe(h["header_sha"]))
    kept, kept_after = on(b["tier"] == "PROTECTED"), on(h["tier"] == "PROTECTED")
    transition = (
        F.when(exact_b & ~exact_h, F.when(h.isNull(), "LEFT-EXACT").otherwise("LOST")).when(exact_h & ~exact_b, F.when(b.isNull(), "ENTERED-EXACT").otherwise("GAINED"))
        .when(edited, F.when(exact_b & exact_h, "EDITED-EXACT").otherwise("EDITED-OFF")).when(both & ~b["expected"].eqNullSafe(h["expected"]), "EXPECTED-CHANGED")
        .when(b.isNull(), "ENTERED").when(h.isNull(), "LEFT").when(kept & ~kept_after, "UNPROTECTED").when(~kept & kept_after, "PROMOTED")
    )
    signed = F.coalesce("_block", "_fresh")
    lost = F.when(kept, "protected_lost").when(F.col("_block").isNull(), "lost_without_demotion").when(on("_quarantine") & ~F.col("_block"), "demotion_not_signed")
    changed = F.when(kept & ~(on("_up") & b["header_sha"].eqNullSafe(h["header_sha"])), F.when(b["block_sha"].eqNullSafe(h["block_sha"]), "protected_header_edited").otherwise("protected_block_edited"))
    bare = F.when(signed.isNotNull(), F.when(on("_quarantine") & ~signed, "demotion_not_signed")).when(~F.lit(oracle_changed), "unprotected_without_demotion")
    is_ = lambda *x: F.col("transition").isin(*x)
    fails = F.when(is_("LOST", "LEFT-EXACT"), lost).when(is_("EDITED-EXACT"), changed).when(is_("GAINED", "ENTERED-EXACT") & on("_conflict"), "conflict_gained").when(is_("UNPROTECTED"), bare)
    out = rows.withColumn("transition", transition).filter("transition IS NOT NULL").withColumn("fails", fails)
    audit = F.when(F.col("fails").isNull() & edited, F.when(is_("GAINED"), "import").when(is_("EDITED-EXACT"), "base"))
    out = out.select("chart", "transition", b["tier"].alias("tier_base"), h["tier"].alias("tier_head"), "fails", audit.alias("audit"))
    unsigned = demotions.filter(F.col("added") & (F.length(F.trim(F.coalesce("owner", F.lit("")))) == 0)).select("chart").distinct()
    nothing = F.lit(None).cast("string")
    return out.union(unsigned.select("chart", F.lit("LEDGER"), nothing, nothing, F.lit("demotion_without_owner"), nothing))


def declared_net(transitions: DataFrame, declared: int) -> DataFrame:
    """net, declared, ok: gained less lost charts against what the change declares."""
    net = F.coalesce(F.sum(F.when(F.col("transition").isin("GAINED", "ENTERED-EXACT"), 1).when(F.col("transition").isin("LOST", "LEFT-EXACT"), -1).otherwise(0)), F.lit(0))
    return transitions.agg(net.alias("net")).withColumn("declared", F.lit(declared).cast("long")).withColumn("ok", F.col("net") == F.col("declared"))


def build_conflicts(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """chart, reasons: two_on_side, count_disagrees, twin.

    rows(chart, vid, side, verified, expected, implied, block_sha); catalog(chart, count).
    two_on_side: another chart on the side of the video (a verified one is exempt);
    count_disagrees: expected isn't the file's count though the file matches the one
    catalog row; twin: another chart has the same block.
    """
    one = catalog.groupBy("chart").agg(F.min("count").alias("_count"), F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    out = rows.join(one, "chart", "left")
    on_side, twins = F.count("*").over(Window.partitionBy("vid", "side")), F.count("*").over(Window.partitionBy("block_sha"))
    out = out.withColumn("_side", on_side).withColumn("_twins", twins)
    reasons = F.array_compact(F.array(F.when((F.col("_side") > 1) & ~F.col("verified"), "two_on_side"), F.when((F.col("expected") != F.col("implied")) & (F.col("implied") == F.col("_count")), "count_disagrees"), F.when(F.col("_twins") > 1, "twin")))
    return out.withColumn("reasons", reasons).filter(F.size("reasons") > 0).select("chart", "reasons")


def long_form(df: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """key, field, value (as text): one row for each field."""
    return df.select(*key, F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("_f")).select(*key, "_f.field", "_f.value")


def diff_ledgers(ledger: DataFrame, base: DataFrame, new: DataFrame, key: Sequence[str], fields: Sequence[str], intended: DataFrame) -> DataFrame:
    """key, field, changed, drift, class: fields that differ between new and base, or between base and the ledger.

    INTENDED (a change whose key is in intended), UNINTENDED, or PRE_EXISTING (drift only).
    """
    part = lambda df, name: long_form(df, key, fields).withColumnRenamed("value", name)
    rows = part(new, "_new").join(part(base, "_base"), [*key, "field"], "full_outer").join(part(ledger, "_ledger"), [*key, "field"], "left")
    rows = rows.withColumn("changed", ~F.col("_new").eqNullSafe(F.col("_base"))).withColumn("drift", ~F.col("_base").eqNullSafe(F.col("_ledger"))).filter("changed OR drift")
    rows = rows.join(intended.select(*key, F.lit(True).alias("_i")).distinct(), list(key), "left")
    kind = F.when(F.col("changed") & F.col("_i").isNotNull(), "INTENDED").when(F.col("changed"), "UNINTENDED").otherwise("PRE_EXISTING")
    return rows.select(*key, "field", "changed", "drift", kind.alias("class"))


def what_if(grade: Callable[[DataFrame], DataFrame], ledger: DataFrame, extra: DataFrame) -> DataFrame:
    """chart, state: both, appears, disappears or changes, of grade(ledger) against grade with the extra rows. grade gives (chart, verdict)."""
    a = grade(ledger).select("chart", F.col("verdict").alias("_a"))
    b = grade(ledger.unionByName(extra)).select(F.col("chart").alias("_chart"), F.col("verdict").alias("_b"))
    both = a.join(b, F.col("chart") == F.col("_chart"), "full_outer")
    state = F.when(F.col("_a").isNull(), "appears").when(F.col("_b").isNull(), "disappears").when(F.col("_a") == F.col("_b"), "both").otherwise("changes")
    return both.select(F.coalesce("chart", "_chart").alias("chart"), state.alias("state"))


def changed_blocks(a: DataFrame, b: DataFrame, key: Sequence[str] = ("path", "description", "songtype"), text: str = "text") -> DataFrame:
    """key, change: added, removed or changed; line ends don't count."""
    sha = F.sha2(F.regexp_replace(text, "\r\n?", "\n"), 256)
    both = a.select(*key, sha.alias("_a")).join(b.select(*key, sha.alias("_b")), list(key), "full_outer")
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return both.withColumn("change", change).filter("change IS NOT NULL").select(*key, "change")


def blast_radius(old: DataFrame, new: DataFrame, edited: DataFrame) -> DataFrame:
    """key, kind: what a change moved. old and new (key, grid, ticks), edited(key).

    moved (as edited), stray (moved without an edit), silent (edited, nothing moved or
    added), dropped, added.
    """
    rows = old.select("key", F.col("grid").alias("_g0"), F.col("ticks").alias("_t0"), F.lit(True).alias("_o")).join(new.select("key", F.col("grid").alias("_g1"), F.col("ticks").alias("_t1"), F.lit(True).alias("_n")), "key", "full_outer")
    rows = rows.join(edited.select("key", F.lit(True).alias("_e")).distinct(), "key", "full_outer")
    differs = ~F.col("_g0").eqNullSafe(F.col("_g1")) | ~F.col("_t0").eqNullSafe(F.col("_t1"))
    kind = F.when(F.col("_o").isNull() & F.col("_n").isNull(), "silent").when(F.col("_n").isNull(), "dropped").when(F.col("_o").isNull(), "added").when(differs & F.col("_e").isNotNull(), "moved").when(differs, "stray").when(F.col("_e").isNotNull(), "silent")
    return rows.withColumn("kind", kind).filter("kind IS NOT NULL").select("key", "kind")


def verify_release(checks: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """check, ok, n_bad, samples: one row for each (name, rows, what makes a row bad); rows have a column name. Up to five samples each."""
    out = None
    for name, rows, bad in checks:
        hits = rows.filter(bad)
        few = hits.select("name").orderBy("name").limit(5).agg(F.array_sort(F.collect_list("name")).alias("samples"))
        row = hits.agg(F.count("*").alias("n_bad")).crossJoin(few).select(F.lit(name).alias("check"), (F.col("n_bad") == 0).alias("ok"), "n_bad", "samples")  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def release_gaps(table: DataFrame, entries: DataFrame) -> DataFrame:
    """name, gap: missing_entry, orphan_entry or differs, between a table's (name, sha) and an archive's entries(name, sha)."""
    both = table.select("name", F.col("sha").alias("_a")).join(entries.select("name", F.col("sha").alias("_b")), "name", "full_outer")
    gap = F.when(F.col("_b").isNull(), "missing_entry").when(F.col("_a").isNull(), "orphan_entry").when(F.col("_a") != F.col("_b"), "differs")
    return both.withColumn("gap", gap).filter("gap IS NOT NULL").select("name", "gap")


def guarded_update(target: DataFrame, changes: DataFrame, key: str, value: str) -> DataFrame:
    """target with value updated, and applied: only where its value is the old one that changes(key, old, new) expects; again does nothing more."""
    rows = target.join(changes.select(key, F.col("old").alias("_old"), F.col("new").alias("_new"), F.lit(True).alias("_c")), key, "left")
    hit = F.coalesce(F.col("_c") & F.col(value).eqNullSafe(F.col("_old")), F.lit(False))
    return rows.withColumn("applied", hit).withColumn(value, F.when(hit, F.col("_new")).otherwise(F.col(value))).select(*target.columns, "applied")


def update_shortfall(updated: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """asked, applied, short: how many changes took effect."""
    n = changes.select(key).distinct().join(updated.select(key, "applied"), key, "left")
    return n.agg(F.count("*").alias("asked"), F.count_if("applied").alias("applied")).withColumn("short", F.col("asked") - F.col("applied"))


def audit_series(files: DataFrame, reads: DataFrame, expected: DataFrame, late: float = 3.0) -> DataFrame:
    """vid, class: empty (0 bytes), unloadable (no read), sidecar_mismatch, starts_late, truncated (over `late` before the expected end), range_scan, orphan_sidecar or fine.

    files(vid, bytes, sidecar_lines, has_file), reads(vid, t), expected(vid, start, end, ranged).
    """
    seen = reads.groupBy("vid").agg(F.min("t").alias("_a"), F.max("t").alias("_b"), F.count("*").alias("_n"))
    rows = files.join(seen, "vid", "left").join(expected, "vid", "left")
    c = F.col
    kind = (
        F.when(~c("has_file"), "orphan_sidecar").when(c("bytes") == 0, "empty").when(c("_n").isNull(), "unloadable").when(c("sidecar_lines").isNotNull() & (c("sidecar_lines") != c("_n")), "sidecar_mismatch")
        .when(F.coalesce("ranged", F.lit(False)), "range_scan").when(c("_a") > c("start") + late, "starts_late").when(c("_b") < c("end") - late, "truncated").otherwise("fine")
    )
    return rows.select("vid", kind.alias("class"))


def dedupe_compute(jobs: DataFrame, key: Sequence[str], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """jobs with what compute gives for each distinct key, computed once; compute keeps the key columns."""
    return jobs.join(compute(jobs.select(*key).distinct()), list(key), "left")
