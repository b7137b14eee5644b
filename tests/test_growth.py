"""Work that must not grow faster than the input: what is joined, and what is done a key at a time; with results by hand or in plain Python."""

import random

from stepwise.functions import scalars
from stepwise.operators import _range, align, match, pins, pricing, reconcile, series, signals

from stepwise.plans import sweep
from stepwise.plans.registry import collect
from stepwise.sources import corpus

from .conftest import rows

QUERIES = collect("QUERIES")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_charts_meet_one_row_a_code_and_era(spark):
    titles = spark.createDataFrame([(k, k, k % 2, "s", ["a", "b"]) for k in range(50)] + [(90, None, 3, "s", ["a"])], "source long, seen long, era int, name string, codes array<string>")
    catalog = spark.createDataFrame([(k, "s", "ab"[k % 2], k // 2 % 4) for k in range(16)], "chart long, name string, code string, era int")
    current = spark.createDataFrame([(0, 0, 0), (1, 5, None)], "chart long, source long, era int")
    got = match.newest_source(titles, catalog, current)
    want = [(k, 90 if k // 2 % 4 == 3 else k // 2 % 4, k // 2 % 4) for k in range(16) if k // 2 % 4 in (0, 1) or (k // 2 % 4 == 3 and k % 2 == 0)]
    assert rows(got, "chart", "source", "era") == sorted(want, key=repr)
    below = plan(got).split("Join Inner")[1]
    assert "min_by" in below, "titles are reduced before they meet the charts"


def cascade(ours, theirs):
    """All candidates of one file in order."""
    alike = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if set(a) | set(b) else 0
    found = []
    for x, s1, e1, m1 in ours:
        for y, s2, e2, m2 in theirs:
            score, near = alike(e1, e2), abs(m1 - m2)
            rung = 0 if s1 == s2 else 1 if sorted(e1) == sorted(e2) else 2 if near == 0 else 3 if score >= 0.5 else 4 if near <= 2 else None
            if rung is not None:
                found.append((rung, -score if rung == 3 else near if rung == 4 else 0, x, y))
    a, b, out = set(), set(), []
    for rung, _, x, y in sorted(found):
        if x not in a and y not in b:
            a.add(x), b.add(y)
            out.append((("identical", "events", "meter", "similar", "near_meter")[rung], x, y))
    return out + [("left", x[0], None) for x in ours if x[0] not in a] + [("left", None, y[0]) for y in theirs if y[0] not in b]


def test_cascade_equals_all_candidates_in_order(spark):
    rng, files = random.Random(7), {}
    for f in range(25):
        side = lambda k: [(2 * i + k, f"s{rng.randrange(6)}", [rng.choice("abcd") for _ in range(rng.randrange(4))], rng.randrange(12)) for i in range(rng.randrange(9))]
        files[f] = side(0), side(1)
    frame = lambda k: spark.createDataFrame([(f, *r) for f, s in files.items() for r in s[k]], "file int, block long, sha string, events array<string>, meter int")
    got = match.pair_cascade(frame(0), frame(1), ["file"])
    assert rows(got) == sorted(((f, *r) for f, s in files.items() for r in cascade(*s)), key=repr)
    assert len({r.rung for r in got.collect()}) == 6
    alike = spark.createDataFrame([(0, k, "s", ["a"], 1) for k in range(3000)], "file int, block long, sha string, events array<string>, meter int")
    got = match.pair_cascade(alike, alike, ["file"])
    assert got.count() == 3000 and "FlatMapGroupsInPandas" not in plan(got)


def test_counts_and_floors_are_done_a_batch_at_a_time(spark):
    n = 12000  # more than one Arrow batch
    equations = spark.createDataFrame([(k, i, j, 1.0 if i == j else 0.5, float(3 + k % 5 + i)) for k in range(n // 4) for i in range(3) for j in ((i, i + 1) if i < 2 else (i,))] + [(None, 0, 0, 1.0, 4.0)], "k int, row long, region long, share double, value double")
    totals = spark.createDataFrame([(k, 10 + k % 7) for k in range(n // 4)] + [(None, 4)], "k int, total long")
    got = reconcile.solve_counts(equations, totals, ["k"])
    assert "FlatMap" not in plan(got)
    sums = {r.k: r.n for r in got.groupBy("k").agg({"count": "sum"}).withColumnRenamed("sum(count)", "n").collect()}
    assert sums == {r.k: r.total for r in totals.collect()}
    floors = spark.createDataFrame([(k // 3, k % 3, float(k % 3), (1, 20, 5)[k % 3], 4) for k in range(n)] + [(None, 0, 0.0, 1, 2)], "k int, region long, t double, target long, floor long")
    got = reconcile.raise_floors(floors, ["k"])
    assert "FlatMap" not in plan(got)
    assert {tuple(r) for r in got.filter("k IS NOT NULL").select("region", "target", "gave").distinct().collect()} == {(0, 4, 0), (1, 17, 3), (2, 5, 0)} and got.count() == n + 1
    assert rows(got.filter("k IS NULL"), "target", "gave") == [(None, 0)]


def test_one_key_over_many_batches(spark):
    floors = spark.createDataFrame([(k // 25000, k, float(k), 5, 4) for k in range(50001)], "k int, region long, t double, target long, floor long")
    got = reconcile.raise_floors(floors, ["k"])
    assert got.count() == got.select("region").distinct().count() == 50001 and got.filter("target <> 5 OR gave <> 0").isEmpty()


def test_songs_with_many_charts_make_no_pairs(spark):
    recs = spark.createDataFrame([(1, "s", "t", "m1", 3), (2, "s", "t", "m9", 4), (3, "s", "t", "m9", 3), (4, "s", "t", "m1", 9), (5, "x", "t", "m1", 3), (6, "s", "u", "m1", 3), (7, "s", "t", "m1", None)], "rec long, song string, type string, mix string, level int")
    catalog = spark.createDataFrame([(10, "s", "t", "m1", 3, False), (11, "s", "t", "m2", 3, True), (12, "s", "t", "m2", 4, False), (13, "s", "u", "m2", 3, False), (14, "s", "u", "m3", 3, False)], "chart long, song string, type string, mix string, level int, current boolean")
    got = match.match_catalog(recs, catalog)
    assert rows(got, "rec", "match", "chart") == [(1, "own_mix", 10), (2, "any_mix", 12), (3, "current", 11), (4, "unmatched_level", None), (5, "unmatched_song", None), (6, "ambiguous", None), (7, "unmatched_level", None)]
    assert "collect_set" not in plan(got) and plan(got).count("Aggregate") >= 3


def test_names_are_found_by_two_words_and_compared_where_they_are_found(spark):
    docs = spark.createDataFrame([(1, "A b, C d! a"), (2, "b c"), (None, "x a B c"), (3, None), (4, ""), (5, "ab c")], "doc long, text string")
    names = spark.createDataFrame([("a",), ("B-c",), ("a b c d",), ("c d a b",), ("b c",), ("...",), (None,)], "name string")
    want = [(1, "B-c"), (1, "a"), (1, "a b c d"), (1, "b c"), (2, "B-c"), (2, "b c"), (None, "B-c"), (None, "a"), (None, "b c")]
    got = match.name_scan(docs, names)
    assert rows(got) == rows(match.phrase_scan(docs, names, most=0)) == sorted(want, key=repr)
    assert "array_join" not in plan(got) and "broadcast" in plan(got) and plan(got).count("RepartitionByExpression") == 0


def test_tempi_are_tried_once_and_near_their_rows(spark):
    notes = spark.createDataFrame([(s, 60 / 61.5 / 12 * k) for s in ("a", "b", None) for k in range(40)], "s string, t double")
    tempi = spark.range(0, 9).selectExpr("60 + id / 2 AS bpm")
    got = align.tempo_scan(notes, ["s"], tempi)
    assert plan(got).count("Join Cross") == 1, "the best and the next best tempo come from one scan"
    assert {r.s: r.bpm for r in got.collect()} == {"a": 61.5, "b": 61.5, None: 61.5}
    assert {r.s: r.elsewhere is None for r in got.collect()} == {"a": False, "b": False, None: True}
    fine = pins.tempo_and_origin(notes, ["s"], got.select("s", "bpm"))
    assert "cos" not in plan(fine).lower(), "the fine search is kept, not done again for each use"
    assert {r.s: round(r.bpm, 6) for r in fine.collect()} == {"a": 61.5, "b": 61.5}


def test_short_runs_and_tracks_share_calls(spark):
    n = 12000  # more than one Arrow batch
    reads = spark.createDataFrame([(k // 4 if k else None, k % 4, (5, 9, 7, 8)[k % 4]) for k in range(n)] + [(1, None, 9)], "s int, t long, v long")
    got = series.lnds(reads, ["s"])
    assert "FlatMapGroups" not in plan(got) and got.filter("v = 9").count() == 1 and got.count() == 3 * n // 4 + 1
    assert "FlatMapGroups" not in plan(series.segment_runs(reads, ["s"]))
    seen = reads.selectExpr("s", "t AS frame", "t", "CAST(v AS double) AS y")
    got = signals.track(seen, ["s"], reach=1.5)
    assert "FlatMapGroups" not in plan(got) and got.count() == n + 1
    assert rows(got.filter("s = 7"), "frame", "track") == [(0, 0), (1, 1), (2, 2), (3, 1)]


def test_partitions_grow_with_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(100)
    assert _range.dealt(df, ["id"], 10, 10).rdd.getNumPartitions() == least
    assert _range.dealt(df, ["id"], 10 * least + 1, 10).rdd.getNumPartitions() == least + 1


def test_merging_moves_lines_once(spark, sf):
    got = QUERIES["h1_merge_nested"](spark, sf)
    got.collect()
    text = got._jdf.queryExecution().executedPlan().toString()
    text = text.split("Initial Plan")[0]
    assert "hashpartitioning(l_orderkey" in text and text.count("+- Exchange") == text.count("REPARTITION_BY_NUM"), "no exchange but the deal by order"


def test_votes_meet_seeds_without_moving_lines(spark, sf):
    got = QUERIES["i14_score_agreement"](spark, sf)
    assert plan(got).count("Join") == 1, "readers meet the seeds of a packet; all else is grouped"


def test_answers_are_normed(spark):
    given = spark.createDataFrame([(" a,b;;c\n",), ("x y\t\x0b\f\rz",), ("/",), ("|\\",), ("",), (None,), ("a\u00a0b/ /",)], "v string")
    assert [r[0] for r in given.select(scalars.norm_answer(given.v)).collect()] == ["A/B/C", "XYZ", "", "", "", None, "A\u00a0B"]


def test_rates_are_searched_from_kept_inputs(spark, sf):
    assert "parquet" not in plan(QUERIES["g14_rate_scan"](spark, sf)), "tables aren't read again for each use of an input"


def test_places_of_splits(spark):
    spans = [(0, 1), (0, 5), (3, 4), (7, 120), (12, 36), (1, 14), (100, 412)]
    grid, some = pricing._splits(12)
    got = spark.createDataFrame(spans, "b0 long, b1 long").withColumn("_grid", grid).withColumn("_s", some).collect()
    for r in got:
        lo, hi = r.b0, r.b1
        want = sorted(x for x in {*(k * 6 for k in range(lo * 16 // 12 + 1, hi * 16 // 12 + 1)), *(lo * 8 + (hi - lo) * k for k in range(1, 8))} if lo * 8 < x < hi * 8)
        assert r._grid == want and r._s == want[:: max(1, len(want) // 64)]


def step_files(spark):
    text = "#TITLE:t;\n#BPMS:0=120,4=130;\n" + "\n".join(f"#NOTEDATA:;\n#METER:{k};\n#TICKCOUNTS:0=4,8={k},8={k + 1};\n#NOTES:\n10000\n;" for k in range(3))
    return spark.createDataFrame([("head", f"p/{k}/f.txt", "p", str(k), text) for k in range(2)], "rev string, path string, pack string, song string, content string").coalesce(1)


def test_a_file_is_split_once_not_once_a_block(spark):
    blocks = corpus.split_blocks(step_files(spark))
    above = plan(blocks).split("Generate")[0]
    assert "content" not in above and "split" not in above, "above the explode, each block would split its whole file again"
    assert rows(blocks, "song", "block", "header") == [(str(k), b, "#TITLE:t;\n#BPMS:0=120,4=130;") for k in range(2) for b in range(3)]


def test_schedules_are_read_in_one_pass(spark):
    key = ["song", "block"]
    blocks = corpus.parse_tags(corpus.split_blocks(step_files(spark)))
    got = corpus.parse_schedules(blocks, ["BPMS", "TICKCOUNTS", "FAKES"], key)
    assert plan(got).count("LogicalRDD") + plan(got).count("LocalRelation") == 1
    want = [(str(s), b, tag, beat, value) for s in range(2) for b in range(3) for tag, beat, value in (("BPMS", 0.0, 120.0), ("BPMS", 4.0, 130.0), ("TICKCOUNTS", 0.0, 4.0), ("TICKCOUNTS", 8.0, b + 1.0))]
    assert rows(got, *key, "tag", "beat", "value") == sorted(want, key=repr)
    assert "Union" not in plan(QUERIES["a4_parse_schedule"](spark, "/root/testdata/sf0.001"))


def test_the_sweep_reads_notes_and_schedules_once(spark):
    key = ["song", "block"]
    blocks = corpus.parse_tags(corpus.split_blocks(step_files(spark))).select(*key, "tags").checkpoint()
    counts = blocks.select(*key).selectExpr(*key, "1L AS count1", "CAST(NULL AS BIGINT) AS count2")
    got = sweep.swept_blocks(blocks, counts, key)
    assert "posexplode" not in plan(got), "notes and schedules are kept where they are read"
    assert rows(got, *key, "status", "taps", "implied", "verdict") == [(str(s), b, "ok", 1, 1, "exact") for s in range(2) for b in range(3)]
