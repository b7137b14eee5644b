"""Matching, source ladders and diffs."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._range import nearest
from .pairing import equal_ranks


def greedy_pairs(obs: Sequence[float], ref: Sequence[float], tol: float) -> list[tuple[int, int]]:
    """Each observation in order takes the nearest unused ref within tol (the earlier of two equally near)."""
    used, out = [False] * len(ref), []
    for i, t in enumerate(obs):
        best = None
        j = bisect_left(ref, t - tol)
        while j < len(ref) and ref[j] <= t + tol:
            if not used[j] and (best is None or abs(ref[j] - t) < abs(ref[best] - t)):
                best = j
            j += 1
        if best is not None:
            used[best] = True
            out.append((i, best))
    return out


def match_one_to_one(obs: DataFrame, ref: DataFrame, by: Sequence[str], tol: float) -> DataFrame:
    """by, kind, obs, ref, error: pair, extra (ref null) or missing (obs null) by greedy matching in order of obs.

    obs(by, t) and ref(by, t). A key's rows must fit a task; use a key of series and
    column. See match_mutual for the form without Python.
    """
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in obs.select(*by).schema.fields)
    kind = obs.schema["t"].dataType.simpleString()

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = sorted(left["t"]), sorted(right["t"])
        pairs = greedy_pairs(a, b, tol)
        seen_a, seen_b = {i for i, _ in pairs}, {j for _, j in pairs}
        rows = [("pair", a[i], b[j], a[i] - b[j]) for i, j in pairs]
        rows += [("extra", x, None, None) for i, x in enumerate(a) if i not in seen_a]
        rows += [("missing", None, x, None) for j, x in enumerate(b) if j not in seen_b]
        out = pd.DataFrame(rows, columns=["kind", "obs", "ref", "error"])
        if kind == "bigint":
            out = out.astype({"obs": "Int64", "ref": "Int64", "error": "Int64"})
        for name, value in reversed(list(zip(by, key, strict=True))):
            out.insert(0, name, value)
        return out

    return obs.groupBy(*by).cogroup(ref.groupBy(*by)).applyInPandas(run, f"{keys}, kind string, obs {kind}, ref {kind}, error {kind}")


def match_mutual(obs: DataFrame, ref: DataFrame, by: Sequence[str], tol: float) -> DataFrame:
    """by, obs, ref: pairs in which each is the other's nearest within tol (ties: the earlier)."""
    forth = nearest(obs.select(*by, "t"), ref.select(*by, "t"), by, "t", "ref", tol).filter("ref IS NOT NULL").select(*by, F.col("t").alias("obs"), "ref")
    back = nearest(ref.select(*by, "t"), obs.select(*by, "t"), by, "t", "obs", tol).filter("obs IS NOT NULL").select(*by, F.col("t").alias("ref"), "obs")
    return forth.join(back, [*by, "obs", "ref"], "left_semi").distinct()


def classify_edits(rows: DataFrame, retime: float = 0.06, duplicate: float = 0.035, streak: float = 0.6) -> DataFrame:
    """rows with edit: the first rung of the ladder that holds.

    rows: kind (pair, extra, missing), file_hold, seen_hold (booleans), tail_error,
    rail_share, fake, flashed, gap_same (to the nearest note of its column), frames,
    median_frames, other_column (a note of another column lies there), has_rail.
    """
    c = F.col
    pair, extra, missing = c("kind") == "pair", c("kind") == "extra", c("kind") == "missing"
    return rows.withColumn(
        "edit",
        F.when(pair & ~c("file_hold") & c("seen_hold"), "tap_to_hold").when(pair & c("file_hold") & (F.abs("tail_error") > retime), "move_tail")
        .when(pair & c("file_hold") & (c("rail_share") < 0.5), "thin_rail").when(missing & c("fake"), "fake").when(missing & ~c("flashed"), "unflashed").when(missing, "unseen")
        .when(extra & (c("gap_same") <= duplicate), "duplicate").when(extra & (c("frames") < streak * c("median_frames")), "short_streak").when(extra & c("other_column"), "column_confusion")
        .when(extra & c("has_rail"), "add_hold").when(extra, "add_tap").otherwise("same"),
    )


def diff_events(a: DataFrame, b: DataFrame, key: Sequence[str], symbol: str = "sym") -> DataFrame:
    """key, kind, a_symbol, b_symbol: same, only_a, only_b or changed for each position. Positions must be unique on a side."""
    left = a.select(*key, F.col(symbol).alias("a_symbol"), F.lit(True).alias("_a"))
    right = b.select(*key, F.col(symbol).alias("b_symbol"), F.lit(True).alias("_b"))
    both = left.join(right, list(key), "full_outer")
    kind = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(F.col("a_symbol").eqNullSafe(F.col("b_symbol")), "same").otherwise("changed")
    return both.select(*key, kind.alias("kind"), "a_symbol", "b_symbol")


def diff_kind(notes: Column, timing: Column, ticks: Column) -> Column:
    """What two versions differ in, from booleans: 'notes', 'timing', 'ticks', joined by +, or 'same'."""
    parts = F.array_compact(F.array(F.when(notes, "notes"), F.when(timing, "timing"), F.when(ticks, "ticks")))
    return F.when(F.size(parts) == 0, "same").otherwise(F.array_join(parts, "+"))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as sets; 0 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    whole = F.size(F.array_union(a, b))
    return F.when(whole > 0, both / whole).otherwise(0.0)


def pair_cascade(ours: DataFrame, theirs: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, rung, ours, theirs: greedy passes over one file's blocks, each taking both sides out.

    Blocks are (by, block long, sha, events array<string>, meter int). Rungs: identical
    sha, same events, same meter, Jaccard of events at least 0.5 (best first), nearest
    meter within 2; what is left over has rung 'left'. The candidates of a file are
    ordered by (rung, score, ours, theirs).
    """
    o, t = (df.select(*by, "block", "sha", F.array_sort("events").alias("events"), "meter").checkpoint() for df in (ours, theirs))  # read in every pass
    every, pairs = (o, t), None
    rest = lambda df, side: df.join(pairs.select(*by, F.col(side).alias("block")), [*by, "block"], "left_anti")
    # where keys are equal, the order of the candidates pairs the first two of a key, the second two, and so on
    for rung, key in enumerate((F.col("sha"), F.when(F.col("events").isNotNull(), F.sha2(F.to_json("events", {"ignoreNullFields": "false"}), 256)), F.col("meter"))):
        new = equal_ranks(o, t, by, key).select(*by, F.lit(rung).alias("rung"), "ours", "theirs").checkpoint()
        pairs = new if pairs is None else pairs.unionByName(new)
        o, t = rest(every[0], "ours"), rest(every[1], "theirs")
    a = o.select(*by, F.col("block").alias("ours"), F.col("events").alias("_e1"), F.col("meter").alias("_m1"))
    b = t.select(*by, F.col("block").alias("theirs"), F.col("events").alias("_e2"), F.col("meter").alias("_m2"))
    near = F.abs(F.col("_m1") - F.col("_m2"))
    rows = a.join(b, list(by)).withColumn("_alike", jaccard(F.col("_e1"), F.col("_e2"))).withColumn("rung", F.when(F.col("_alike") >= 0.5, 3).when(near <= 2, 4)).filter("rung IS NOT NULL")
    rows = rows.select(*by, "rung", F.when(F.col("rung") == 3, -F.col("_alike")).otherwise(near).alias("score"), "ours", "theirs")
    order = [*by, "rung", "score", "ours", "theirs"]
    taken = _first_free(rows.repartition(*by).sortWithinPartitions(*order), by)
    pairs = pairs.unionByName(taken.checkpoint())
    names = F.element_at(F.array(*map(F.lit, ("identical", "events", "meter", "similar", "near_meter"))), F.col("rung") + 1)
    left_o = rest(every[0], "ours").select(*by, F.lit("left").alias("rung"), F.col("block").alias("ours"), F.lit(None).cast("long").alias("theirs"))
    left_t = rest(every[1], "theirs").select(*by, F.lit("left").alias("rung"), F.lit(None).cast("long").alias("ours"), F.col("block").alias("theirs"))
    return pairs.select(*by, names.alias("rung"), "ours", "theirs").unionByName(left_o).unionByName(left_t)


def _first_free(candidates: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, rung, ours, theirs: the candidates of each key, sorted in their partition, of which both sides are free when they come. What is held is the sides taken of one key."""
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.select(*by).schema.fields)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, a, b = None, set(), set()
        for batch in batches:
            keep = []
            sides = zip(batch.column("ours").to_pylist(), batch.column("theirs").to_pylist(), strict=True)
            for i, (key, (x, y)) in enumerate(zip(zip(*(batch.column(k).to_pylist() for k in by), strict=True), sides, strict=True)):
                if key != now:
                    now, a, b = key, set(), set()
                if x not in a and y not in b:
                    a.add(x)
                    b.add(y)
                    keep.append(i)
            yield batch.select([*by, "rung", "ours", "theirs"]).take(pa.array(keep, pa.int64()))

    return candidates.mapInArrow(take, f"{keys}, rung int, ours long, theirs long")


def match_catalog(recs: DataFrame, catalog: DataFrame) -> DataFrame:
    """recs(rec, song, type, mix, level) with match and chart: the first rung with exactly one catalog row(chart, song, type, mix, level, current).

    Rungs: own mix and level; any mix, same level; the one alive in the current mix of
    these. Else `ambiguous` (several), `unmatched_level` (the song exists), `unmatched_song`.
    """
    pool = catalog.filter("chart IS NOT NULL")
    song, level = ["song", "type"], ["song", "type", "level"]

    def several(name: str, charts: Column = F.col("chart")) -> tuple[Column, Column]:
        """Whether there is more than one chart (null: none), and the first of them."""
        return (F.min(charts) < F.max(charts)).alias(f"_{name}"), F.min(charts).alias(f"_{name}1")

    # what a rung can find is summed up for each key of the catalog, so a song with many charts and records makes no pairs
    a = pool.groupBy(*level, "mix").agg(*several("a"))
    b = pool.groupBy(*level).agg(*several("b"), *several("c", F.when(F.col("current"), F.col("chart"))))
    n = pool.select(*song).distinct().withColumn("_n", F.lit(True))
    rows = recs.join(a, [*level, "mix"], "left").join(b, level, "left").join(n, song, "left")
    only = lambda name: F.when(~F.col(f"_{name}"), F.col(f"_{name}1"))
    match = F.when(~F.col("_a"), "own_mix").when(~F.col("_b"), "any_mix").when(~F.col("_c"), "current").when(F.col("_b"), "ambiguous").when(F.col("_n"), "unmatched_level").otherwise("unmatched_song")
    return rows.select("rec", *(c for c in recs.columns if c != "rec"), match.alias("match"), F.coalesce(only("a"), only("b"), only("c")).alias("chart"))


def newest_source(titles: DataFrame, catalog: DataFrame, current: DataFrame) -> DataFrame:
    """chart, source, era, action: for each chart that a title names, the source of the newest era (ties: the first seen).

    titles(source, seen, era int, name, codes array<string>), catalog(chart, name, code,
    era int): a code is looked up at its title's era. current(chart, source, era): what is
    used now. action: none (nothing is used), current (that very source), unknown (of no known era), upgrade, as_new (what is used is as new or newer).
    Of a code's titles of one era only the first seen can win, so charts meet one row for each code and era.
    """
    named = titles.withColumn("code", F.explode("codes")).groupBy("name", "code", "era").agg(F.min_by(F.struct("source", "seen"), F.struct(F.col("seen").isNull(), "seen")).alias("_t"))
    found = named.select("name", "code", "era", "_t.source", "_t.seen").join(catalog, ["name", "code", "era"])
    best = found.groupBy("chart").agg(F.max_by(F.struct("source", "era"), F.struct(F.col("era"), -F.col("seen"))).alias("_b"))
    rows = best.join(current.select("chart", F.col("source").alias("_now"), F.col("era").alias("_era"), F.lit(True).alias("_has")), "chart", "left")
    action = F.when(F.col("_has").isNull(), "none").when(F.col("_b.source") == F.col("_now"), "current").when(F.col("_era").isNull(), "unknown").when(F.col("_b.era") > F.col("_era"), "upgrade").otherwise("as_new")
    return rows.select("chart", "_b.source", "_b.era", action.alias("action"))


def sides(codes: DataFrame, by: Sequence[str]) -> DataFrame:
    """codes(by, code, level) with side: of two codes the lower level is Left (ties: the smaller code), a single one Center."""
    order = Window.partitionBy(*by).orderBy("level", "code")
    n = F.count("*").over(Window.partitionBy(*by))
    return codes.withColumn("side", F.when(n == 1, "Center").when(F.row_number().over(order) == 1, "Left").otherwise("Right"))


def copies_disagree(files: DataFrame) -> DataFrame:
    """copies of a file(name, copy, date, block_sha) with signature, current (the newest; ties: the smallest copy) and agrees (with the current one)."""
    signed = files.groupBy("name", "copy", "date").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("block_sha")), ","), 256).alias("signature"))
    order = Window.partitionBy("name").orderBy(F.desc("date"), "copy")
    newest = F.first("signature").over(order)
    return signed.withColumn("current", F.row_number().over(order) == 1).withColumn("agrees", F.col("signature") == newest)


def twins(blocks: DataFrame, key: Sequence[str], name: str = "block") -> DataFrame:
    """Blocks whose key columns all equal another's, with n and the smallest other name (twin)."""
    order = Window.partitionBy(*key).orderBy(name)
    n, low = F.count("*").over(Window.partitionBy(*key)), F.first(name).over(order)
    rows = blocks.withColumn("n", n).withColumn("twin", F.when(F.row_number().over(order) == 1, F.lead(name).over(order)).otherwise(low))
    return rows.filter("n > 1").select(*blocks.columns, "n", "twin")


def resolve_reference(df: DataFrame, sources: Mapping[str, DataFrame], by: Sequence[str], value: str = "expected") -> DataFrame:
    """df with value and source: the first source, in order, that has a value for the key. Sources have unique keys."""
    out = df
    for i, src in enumerate(sources.values()):
        out = out.join(src.select(*by, F.col(value).alias(f"_v{i}")), list(by), "left")
    pick = F.coalesce(*(F.col(f"_v{i}") for i in range(len(sources))))
    which = F.coalesce(*(F.when(F.col(f"_v{i}").isNotNull(), name) for i, name in enumerate(sources)))
    return out.select(*df.columns, pick.alias(value), which.alias("source"))


def name_scan(docs: DataFrame, names: DataFrame) -> DataFrame:
    """doc, name: whole-word occurrences of names(name) in docs(doc, text), without regard to case; see phrase_scan."""
    return phrase_scan(docs, names)


def phrase_scan(docs: DataFrame, names: DataFrame, most: int = 100_000) -> DataFrame:
    """doc, name: where the whole word sequence of a name occurs in a doc, without regard to case; words are runs of a-z and 0-9.

    docs(doc, text), names(name), of any length. Only hashes of one or two words are exploded from texts; they meet the
    first words of the names, and the places found are compared in full with the text. Up to `most` names are sent to all
    tasks, which compare where they find, so a text is cut once and stays where it is; more are joined, and the places
    found are joined with their texts. Names without words occur nowhere.
    """
    split = lambda c: F.array_remove(F.split(F.lower(c), "[^a-z0-9]+"), "")
    words = docs.select("doc", split(F.col("text")).alias("_w"))
    keys = names.select("name", split(F.col("name")).alias("_all")).distinct().filter("size(_all) > 0")
    keys = keys.withColumn("_n", F.least(F.size("_all"), F.lit(2))).withColumn("_h", F.when(F.col("_n") == 1, F.xxhash64(F.get("_all", F.lit(0)))).otherwise(F.xxhash64(F.get("_all", F.lit(0)), F.get("_all", F.lit(1)))))
    starts = {1: F.transform("_w", lambda w: F.xxhash64(w)), 2: F.zip_with("_w", F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))}
    counts = {r["_n"]: r["count"] for r in keys.groupBy("_n").count().collect()}  # two rows at most
    few = sum(counts.values()) <= most
    whole = F.slice("_w", F.col("_i") + 1, F.size("_all")) == F.col("_all")
    found = docs.select("doc", F.lit(None).cast("string").alias("name")).limit(0)
    for n in counts:
        at = words.select("doc", *(["_w"] if few else []), F.posexplode_outer(starts[n]).alias("_i", "_h"))  # outer: without a filter that cuts all texts once more
        key = keys.filter(F.col("_n") == n).select("name", "_all", "_h")
        if few:
            hits = at.join(F.broadcast(key), "_h").filter(whole)
        else:
            hits = at.join(key, "_h").select(F.col("doc").alias("_d"), "_i", "name", "_all")
            hits = hits.join(words, F.col("_d").eqNullSafe(F.col("doc"))).filter(whole)
        found = found.unionByName(hits.select("doc", "name"))
    return found.distinct()


def match_rate(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, matched, extra, missing from match_one_to_one."""
    return pairs.groupBy(*by).agg(F.count_if(F.col("kind") == "pair").alias("matched"), F.count_if(F.col("kind") == "extra").alias("extra"), F.count_if(F.col("kind") == "missing").alias("missing"))


def spread_to(hits: DataFrame, links: DataFrame, name: str = "name", via: str = "video") -> DataFrame:
    """Names that share a video (links(name, video)) with a hit name."""
    videos = hits.join(links, name).select(via).distinct()
    return links.join(videos, via, "left_semi").select(name).distinct()


