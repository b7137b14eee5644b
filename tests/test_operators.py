"""Known answers, differential twins in plain Python, and negative controls."""

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stepwise.functions import scalars as fn
from stepwise.operators import evaluate, intervals, ledgers, match, reconcile, series

from .conftest import rows


def test_union_of_holds(spark):
    df = spark.createDataFrame([(0, 10.0, 11.0), (0, 10.5, 12.0), (0, 30.0, 31.0)], "series int, s double, e double")
    assert rows(intervals.union_intervals(df, ["series"]), "s", "e", "n") == [(10.0, 12.0, 2), (30.0, 31.0, 1)]
    twice = intervals.union_intervals(intervals.union_intervals(df, ["series"]).select("series", "s", "e"), ["series"])
    assert rows(twice, "s", "e") == [(10.0, 12.0), (30.0, 31.0)]


def test_simultaneous_rails_have_one_price(spark):
    df = spark.createDataFrame([(0, 88.5, 93.1, 141, None), (0, 88.5, 93.1, 141, None), (0, 120.0, 121.0, None, "fall")], "series int, s double, e double, price int, cause string")
    assert rows(intervals.cluster_price(df, ["series"]), "price", "cause") == [(141, None), (None, "fall")]


@pytest.mark.parametrize("second,n", [(11.02, 1), (11.5, 2)])
def test_rails_that_nearly_touch(spark, second, n):
    df = spark.createDataFrame([(0, 10.0, 11.0), (0, second, 12.0)], "series int, s double, e double")
    assert intervals.union_intervals(df, ["series"], eps=0.05).count() == n


def _lattice(spark, holds, steps, excluded=(), taps=(), unit=48):
    make = lambda data, schema: spark.createDataFrame([(0, *(None if x is None else int(x * unit) for x in row[:2]), *row[2:]) for row in data], schema)
    h = make(holds, "series int, head long, tail long")
    s = make(steps, "series int, b0 long, b1 long, value long")
    x = make(excluded, "series int, s long, e long")
    t = spark.createDataFrame([(0, int(b * unit)) for b in taps], "series int, beat long")
    return [tuple(r) for r in intervals.lattice_count(h, s, x, t, ["series"], unit, 4 * unit).orderBy("b0").select("heads", "ticks", "events").collect()]


def test_lattice_head_and_eight_ticks(spark):
    assert _lattice(spark, [(0, 2)], [(0, None, 4)]) == [(1, 8, 9)]


def test_lattice_two_holds_share_their_lattice(spark):
    assert _lattice(spark, [(260, 266), (260, 267)], [(0, None, 2)]) == [(1, 14, 15)]


def test_lattice_rate_zero_still_judges_the_head(spark):
    assert _lattice(spark, [(4, 6)], [(0, None, 0)]) == [(1, 0, 1)]


def test_lattice_exclusions_and_taps(spark):
    assert _lattice(spark, [(0, 2)], [(0, None, 4)], excluded=[(1, 1.5)]) == [(1, 6, 7)]
    assert _lattice(spark, [(0, 2)], [(0, None, 4)], taps=[0, 0.25]) == [(0, 7, 7)]


def test_lattice_rate_change(spark):
    assert _lattice(spark, [(0, 4)], [(0, 2, 1), (2, None, 2)]) == [(1, 1 + 5, 7)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=12))
def test_longest_rise_is_maximal(values):
    got = [values[i] for i in series.longest_rise(values)]
    assert got == sorted(got)
    best = max((len(c) for n in range(len(values) + 1) for c in itertools.combinations(values, n) if list(c) == sorted(c)), default=0)
    assert len(got) == best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=15).map(sorted), st.lists(st.integers(0, 60), max_size=15).map(sorted))
def test_matching_is_one_to_one(obs, ref):
    pairs = match.greedy_pairs(obs, ref, 5)
    assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
    assert all(abs(obs[i] - ref[j]) <= 5 for i, j in pairs)


def test_digits_restored(spark):
    assert 94 + 700 in [a + 100 * k for a in series.alternatives(94, 999) for k in range(10)]
    df = spark.createDataFrame([(0, float(i), v) for i, v in enumerate((111, 112, 12, 114, 15, 116))], "series int, t double, v long")
    assert [r.v for r in series.continuity_repair(df, ["series"], 5, 999).orderBy("t").collect()] == [111, 112, 112, 114, 115, 116]


def test_upload_titles(spark):
    tag = lambda era, rest: f"[PUMP IT UP {era}] {rest}"
    titles = [tag("PHOENIX", "1949 D22 (pre D21 → D22 / x)"), tag("XX", "Slam(슬램) S18 & SP20 (pre S19 → S20 / x)"), tag("PRIME", "8 6(86) - FULL SONG - S15 & S21 (x)"), tag("PRIME 2", "8 6 (86) S16 & S20 | S20"), tag("PRIME", "no codes here"), tag("RISE", "Song S5"), "Song S5", "Song S5 [PRIME]"]
    df = spark.createDataFrame([(t,) for t in titles], "t string").select(fn.parse_upload_title(F.col("t")).alias("p"))
    got = [None if r.p is None else (r.p.era, r.p.name, r.p.codes, r.p.song_type) for r in df.collect()]
    assert got == [("PHOENIX", "1949", ["D22"], None), ("XX", "slam", ["S18", "S20"], None), ("PRIME", "86", ["S15", "S21"], "FullSong"), ("PRIME 2", "86", ["S16", "S20"], None), ("PRIME", None, [], None), None, None, None]


def test_key_to_tag_round_trip(spark):
    keys = ["Bee_-_BanYa_S17_INFOBAR_TITLE_ARCADE", "Slam_-_Novasonic_D24_ARCADE", "X_-_Y_SP3_FULLSONG", "X_-_Y_UCS_ARCADE", "X_-_Y_D24"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("t", fn.key_to_tag(F.col("k")))
    got = df.select("t", fn.tag_to_key(F.regexp_extract("k", "^([^_]*_-_[^_]*)", 1), F.col("t")).alias("k")).collect()
    assert [r.t for r in got] == ["S17 INFOBAR TITLE_ARCADE", "D24_ARCADE", "SP3_FULLSONG", None, None]
    assert [r.k for r in got] == [*keys[:3], None, None]


def test_families(spark):
    names = ["Beat of The War 2 S17", "Final Audition - SHORT CUT - D9", "Bée (live) S3", "Song ii D4", "슬램 S1", "!!! S2"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [tuple(r) for r in df.select(*(fn.family_of(F.col("n"), v) for v in ("tokens", "sequel", "strip"))).collect()]
    assert got[0] == ("beat of", "beatofthewar", "beat of the war 2") and got[1] == ("final audition", "finalaudition", "final audition")
    assert [g[0] for g in got[2:]] == ["bee live", "song ii", "슬램", "!!!"] and got[3][1] == "song"


def test_grids(spark):
    df = spark.createDataFrame([(1.0,), (1 / 16,), (1 / 12,), (1 / 3,), (0.07,)], "b double")
    assert [r.g for r in df.select(fn.choose_grid(F.col("b")).alias("g")).collect()] == [16, 16, 12, 12, 16]


def test_official_blocks(spark):
    rows = [("pump-single", "ARCADE", 17, "S17"), ("pump-single", None, 5, None), ("pump-couple", "ARCADE", 5, "S5"), ("pump-double", "ARCADE", 99, "D5"), ("pump-double", "ARCADE", 5, "CO-OP x2"), ("pump-double", "ARCADE", 5, "PERFORMANCE D5"), ("pump-double", "ARCADE", 5, "PROMISE D5"), ("pump-double", "ARCADE", 5, "D5 PRO"), ("pump-double", "ARCADE", 5, "MISSION D5")]
    df = spark.createDataFrame(rows, "a string, b string, c int, d string")
    assert [r.o for r in df.select(fn.is_official(*map(F.col, "abcd")).alias("o")).collect()] == [True, True, False, False, False, False, True, False, True]


def test_rationals(spark):
    df = spark.createDataFrame([(1 / 3,), (0.0,), (2.5,), (-0.75,), (3.14159265358979,), (None,)], "x double")
    got = [(r.q.num, r.q.den) for r in df.select(fn.to_rational(F.col("x"), 1000).alias("q")).collect()]
    assert got == [(1, 3), (0, 1), (5, 2), (-3, 4), (355, 113), (None, None)]


@pytest.mark.parametrize("method", ["first", "largest", "remainder"])
def test_allocation_closes_exactly(spark, method):
    df = spark.createDataFrame([(k, i, 100 + k, float((i * 7 + k) % 5)) for k in range(20) for i in range(1 + k % 6)], "k int, item int, total long, weight double")
    out = reconcile.allocate(df, ["k"], method=method)
    assert all(r.s == r.t for r in out.groupBy("k").agg(F.sum("share").alias("s"), F.max("total").alias("t")).collect())


def test_nnls_against_grid():
    import numpy as np

    a, b = np.array([[1.0, 0.5], [0.0, 1.0], [1.0, 1.0]]), np.array([3.0, -1.0, 2.0])
    x = reconcile.nnls(a, b)
    best = min(float(((a @ np.array([p, q]) - b) ** 2).sum()) for p in np.linspace(0, 4, 81) for q in np.linspace(0, 4, 81))
    assert (x >= 0).all() and ((a @ x - b) ** 2).sum() <= best + 1e-9


SHA = {c: c * 64 for c in "abcdef"}
DEMOTION = "chart string, block_sha string, reason string, evidence string, owner string, added boolean"
VERSION = "chart string, exact boolean, block_sha string, header_sha string, expected int, tier string, protected_by string"


def test_tiers(spark):
    rows = spark.createDataFrame([("promoted", SHA["a"], False), ("both", SHA["a"], True), ("imported", SHA["b"], False), ("other block demoted", SHA["b"], True), ("exact", SHA["c"], True), ("off", SHA["c"], False), ("blank", SHA["d"], False)], "chart string, block_sha string, exact boolean")
    imported = spark.createDataFrame([("imported",), ("other block demoted",), ("blank",)], "chart string")
    down = spark.createDataFrame([("both", SHA["a"], "r", "e", None, False), ("other block demoted", SHA["f"], "r", "e", None, False), ("blank", SHA["d"], "r", " ", None, False)], DEMOTION)
    up = spark.createDataFrame([("promoted", SHA["a"], "FLAT", True), ("both", SHA["a"], "FLAT", True), ("off", SHA["c"], "STEEP", True)], "chart string, block_sha string, audit string, covered boolean")
    flagged = spark.createDataFrame([("off", "quarantine"), ("off", "oracle_conflict"), ("both", "owner_revisit")], "chart string, flag string")
    got = {r.chart: (r.protected_by, r.tier, r.flags) for r in ledgers.assign_tiers(rows, imported, down, up, flagged).collect()}
    assert got == {
        "promoted": ("promotion", "PROTECTED", []), "both": (None, "PROVISIONAL", ["demoted", "owner_revisit"]), "imported": ("import", "PROTECTED", []), "other block demoted": (None, "PROVISIONAL", ["demoted"]),
        "exact": (None, "PROVISIONAL", []), "off": (None, None, ["oracle_conflict", "quarantine"]), "blank": ("import", "PROTECTED", []),
    }


def test_gate(spark):
    P, E = "PROTECTED", "PROVISIONAL"  # noqa: N806
    cases = {  # chart: base, head (exact, block, header, expected, tier), what comes out
        "same": ((True, "a", "h", 1, P), (True, "a", "h", 1, P), None),
        "lost": ((True, "a", "h", 1, E), (False, "b", "h", 1, None), ("LOST", "lost_without_demotion")),
        "lost, demoted": ((True, "a", "h", 1, E), (False, "b", "h", 1, None), ("LOST", None)),
        "lost, other block demoted": ((True, "a", "h", 1, E), (False, "b", "h", 1, None), ("LOST", "lost_without_demotion")),
        "lost, protected, demoted": ((True, "a", "h", 1, P), (False, "b", "h", 1, None), ("LOST", "protected_lost")),
        "lost, quarantined": ((True, "a", "h", 1, E), (False, "b", "h", 1, None), ("LOST", "demotion_not_signed")),
        "left": ((True, "a", "h", 1, E), None, ("LEFT-EXACT", "lost_without_demotion")),
        "left, off": ((False, "a", "h", 1, None), None, ("LEFT", None)),
        "entered": (None, (True, "a", "h", 1, E), ("ENTERED-EXACT", None)),
        "entered, off": (None, (False, "a", "h", 1, None), ("ENTERED", None)),
        "gained": ((False, "a", "h", 1, None), (True, "b", "h", 1, E), ("GAINED", None)),
        "gained, conflict": ((False, "a", "h", 1, None), (True, "b", "h", 1, E), ("GAINED", "conflict_gained")),
        "edited": ((True, "a", "h", 1, E), (True, "b", "h", 1, E), ("EDITED-EXACT", None)),
        "edited, protected": ((True, "a", "h", 1, P), (True, "b", "h", 1, P), ("EDITED-EXACT", "protected_block_edited")),
        "header, protected": ((True, "a", "h", 1, P), (True, "a", "i", 1, P), ("EDITED-EXACT", "protected_header_edited")),
        "edited, promoted": ((True, "a", "h", 1, P), (True, "b", "h", 1, P), ("EDITED-EXACT", None)),
        "edited, off": ((False, "a", "h", 1, None), (False, "b", "h", 1, None), ("EDITED-OFF", None)),
        "expected": ((True, "a", "h", 1, E), (True, "a", "h", 2, E), ("EXPECTED-CHANGED", None)),
        "unprotected": ((True, "a", "h", 1, P), (True, "a", "h", 1, E), ("UNPROTECTED", "unprotected_without_demotion")),
        "unprotected, new demotion": ((True, "a", "h", 1, P), (True, "a", "h", 1, E), ("UNPROTECTED", None)),
        "promoted": ((True, "a", "h", 1, E), (True, "a", "h", 1, P), ("PROMOTED", None)),
    }
    side = lambda n: spark.createDataFrame([(c, v[n][0], SHA[v[n][1]], *v[n][2:], None) for c, v in cases.items() if v[n]], VERSION)
    down = [(c, SHA["a"], "r", "e", None, False) for c in ("lost, demoted", "lost, protected, demoted", "lost, quarantined")]
    down += [("lost, other block demoted", SHA["c"], "r", "e", None, False), ("unprotected, new demotion", SHA["c"], "r", "e", "owner", True), ("ledger", SHA["c"], "r", "e", " ", True)]
    up = spark.createDataFrame([("edited, promoted", SHA["b"], "FLAT", True)], "chart string, block_sha string, audit string, covered boolean")
    flagged = spark.createDataFrame([("lost, quarantined", "quarantine"), ("gained, conflict", "oracle_conflict")], "chart string, flag string")
    out = ledgers.gate(side(0), side(1), spark.createDataFrame(down, DEMOTION), up, flagged).collect()
    assert {r.chart: (r.transition, r.fails) for r in out} == {c: v[2] for c, v in cases.items() if v[2]} | {"ledger": ("LEDGER", "demotion_without_owner")}
    assert {r.chart: r.audit for r in out if r.audit} == {"gained": "import", "edited": "base", "edited, promoted": "base"}
    assert ledgers.gate(side(0), side(0), spark.createDataFrame([], DEMOTION)).isEmpty()


def test_sweep_takes_the_first_count(spark):
    rows = spark.createDataFrame([(10, 12, 10), (10, 12, 9), (10, None, 8), (10, None, None), (13, 10, 99)], "implied int, count1 int, count2 int").withColumns({"regions": F.lit(2), "blocks_alike": F.lit(1), "hold_events": F.lit(3)})
    assert [(r.verdict, r.delta, r.pct) for r in reconcile.sweep(rows).collect()] == [("exact", None, None), ("off", -2, -16.7), ("off", 2, 25.0), ("no_count", None, None), ("off", 3, 30.0)]
    assert [r.implied for r in reconcile.sweep(rows.filter("count1 = 10"), 30).collect()] == []


def test_slack_ladder(spark):
    def verdict(*lows):
        anchors = spark.createDataFrame([("x", i, v) for i, v in enumerate(lows)], "s string, t int, cum int")
        return [(r.low, r.tail, r.verdict) for r in reconcile.slack_screen(anchors, spark.createDataFrame([], "s string, t int"), ["s"], 1).collect()]

    assert verdict(-15, 3, 2) == [(-15, 2, "fine")] and verdict(-31, -2, 0, 1, 1) == [(-31, -2, "recovers")] and verdict(-99) == [(-99, 0, "recovers")]
    assert verdict(-9, -20, -30, -48) == [(-48, -48, "deepens")]


def test_excess_clusters(spark):
    reads = [(0.0, 10), (0.2, 10), (0.4, 13), (0.6, 13), (0.9, 16), (1.2, 17), (2.0, 20), (4.0, 40), (4.2, 44), (4.3, 4), (4.4, 9)]
    taps = [(0.9,), (0.95,), (1.0,), (1.01,)]  # seen 0.15 later
    r = spark.createDataFrame([("x", *x) for x in reads], "s string, t double, v int")
    got = [(x.t0, x.t1, x.excess) for x in reconcile.excess_clusters(r, spark.createDataFrame([("x", *x) for x in taps], "s string, t double"), ["s"]).orderBy("t0").collect()]
    assert got == [(0.0, 2.0, 6), (4.0, 4.2, 4), (4.3, 4.4, 5)]


def test_raised_floors(spark):
    def lifted(*rows):
        df = spark.createDataFrame([("x", i, float(t), v, f) for i, (t, v, f) in enumerate(rows)], "k string, region int, t double, target long, floor long")
        return [(r.target, r.gave) for r in reconcile.raise_floors(df, ["k"]).orderBy("region").collect()]

    assert lifted((0, 0, 2), (1, 5, 1), (9, 30, 1)) == [(2, 0), (5, 0), (28, 2)]  # the dominant one, however far
    assert lifted((0, 0, 2), (1, 5, 1), (2, 5, 1), (9, 6, 1)) == [(2, 0), (4, 1), (4, 1), (6, 0)]
    assert lifted((0, 0, 1), (8, 4, 2), (9, 4, 3), (20, 3, 3)) == [(1, 0), (3, 1), (4, 0), (3, 0)]  # none near: anywhere
    assert lifted((0, 0, 3), (1, 2, 1), (2, 2, 2)) == [(None, 0)] * 3


def test_readers_who_leave_a_seed_open_are_void(spark):
    keys = spark.createDataFrame([(1, "s", "seed", "a,b"), (1, "x", "real", None), (2, "y", "real", None)], "packet int, item string, kind string, answer string")
    said = [("p", 1, "s", "A / B"), ("p", 1, "x", "1"), ("q", 1, "x", "1"), ("r", 1, "s", "a|b"), ("r", 1, "x", " 1"), ("p", 2, "y", "2?"), ("q", 2, "y", "2?")]
    got = {r["item"]: (r.verdict, r.answer, r.why) for r in evaluate.score_agreement(keys, spark.createDataFrame(said, "reader string, packet int, item string, answer string")).collect()}
    assert got == {"x": ("AGREED", "1", None), "y": ("UNSURE", None, "unreadable")}


def test_identification(spark):
    def status(*rows, expected=5):
        df = spark.createDataFrame([("x", f"c{i}", own, implied, expected, 1, 1, i, score) for i, (own, implied, score) in enumerate(rows)], "series string, candidate string, own boolean, implied int, expected int, level int, wanted int, place int, score double")
        return [(r.best, r.status) for r in evaluate.identify(df, 0.5, 0.1).collect()][0]

    assert status((True, 4, 0.9), (False, 5, 0.8)) == ("c0", "own") and status((True, 4, 0.4), (False, 5, 0.3)) == ("c0", "own_low")
    assert status((True, 4, 0.2), (False, 5, 0.4)) == ("c1", "unmatched") and status((True, 5, 0.2), (False, 4, 0.9)) == ("c1", "exact_notes_disagree")
    assert status((True, 4, 0.2), (False, 5, 0.9)) == ("c1", "candidate") and status((True, 4, 0.85), (False, 5, 0.9)) == ("c1", "ambiguous")
    assert status((True, 4, None), (False, 5, 0.9)) == ("c1", "unscored") and status((True, 4, 0.2), (False, 4, 0.9), (False, 5, 0.9)) == ("c2", "candidate")


def test_components_of_a_long_chain(spark):
    from stepwise.operators.components import connected

    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 17] + [(5, 5)], "u long, v long")
    assert {r.node: r.component for r in connected(edges).collect()} == {i: 0 if i <= 17 else 18 for i in range(41)}


def test_swaps_are_restored_and_a_blind_rule_restores_none(spark):
    m = spark.createDataFrame([(i, i * 7) for i in range(50)], "chart long, key long")
    knows = lambda s: s.filter("key <> chart * 7").select("chart", (F.col("chart") * 7).alias("to_key"))
    assert evaluate.swap_drill(m, 5, "x", knows).filter("NOT restored").isEmpty()
    blind = lambda s: s.filter("chart < 0").select("chart", F.col("key").alias("to_key"))
    assert evaluate.swap_drill(m, 5, "x", blind).filter("restored").isEmpty()


def test_empty_tables(spark):
    e = spark.createDataFrame([], "series int, s double, e double")
    assert intervals.union_intervals(e, ["series"]).isEmpty()
    p = spark.createDataFrame([], "series int, t double")
    assert intervals.count_between(p, e.select("series", F.col("s").alias("lo"), F.col("e").alias("hi")), ["series"]).isEmpty()


def test_long_names_are_looked_up_whole(spark):
    words = [f"w{i}" for i in range(40)]
    long, other, exact = " ".join(words[:30]), " ".join([*words[:29], "x"]), " ".join(words[5:17])
    texts = [f"a, {long.upper()}! b", " ".join(words[:29]), f"{' '.join(words[:12])} {other}", exact, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    names = spark.createDataFrame([(long,), (other,), (exact,), ("W3 w4",), ("",), (None,)], "name string")
    want = {(0, long), (2, other), *((d, exact) for d in (0, 1, 2, 3)), *((d, "W3 w4") for d in (0, 1, 2))}
    assert rows(match.name_scan(docs, names)) == sorted(want, key=repr)
    assert rows(match.name_scan(docs, names.filter("length(name) > 100"))) == sorted(((0, long), (2, other)), key=repr)
