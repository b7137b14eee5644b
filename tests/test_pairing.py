"""Pairing in passes against plain greedy choosing."""

import random

from pyspark.sql import functions as F

from stepwise.operators import pairing
from stepwise.plans import pairing as plans


def greedy(ours, theirs):
    """ours and theirs: [(block, events or None, timing, meter)] of one family, chosen in order, pass by pass."""
    free, open_, out = dict.fromkeys(x[0] for x in theirs), list(ours), []
    by_block = {x[0]: x for x in theirs}

    def jaccard(o, t):
        a, b = set(o[1]), set(t[1])
        return 1 - len(a & b) / len(a | b) if a | b and 2 * len(a & b) >= len(a | b) else None

    rules = [
        ("identical", lambda o, t: 0 if set(o[1]) == set(t[1]) and o[2] == t[2] else None), ("same_events", lambda o, t: 0 if set(o[1]) == set(t[1]) else None),
        ("same_meter", lambda o, t: 0 if o[3] == t[3] else None), ("similar", jaccard), ("near_meter", lambda o, t: abs(o[3] - t[3]) if abs(o[3] - t[3]) <= 2 else None),
    ]
    for rung, score in rules:
        for o in list(open_):
            if o[1] is None:
                continue
            some = sorted((s, b) for b in free if by_block[b][1] is not None and (s := score(o, by_block[b])) is not None)
            if some:
                out.append((rung, o[0], some[0][1]))
                free.pop(some[0][1])
                open_.remove(o)
    return sorted([*out, *(("left", o[0], None) for o in open_), *(("left", None, b) for b in free)], key=repr)


def expected(ours, theirs):
    """Rows of (file, family, block, events, timing, meter)."""
    files = {(r[0], r[1]) for r in [*ours, *theirs]}
    of = lambda rows, f: sorted((r[2:] for r in rows if r[:2] == f), key=lambda r: r[0])
    return sorted(((*f, *x) for f in files for x in greedy(of(ours, f), of(theirs, f))), key=repr)


SCHEMA = "file int, family string, block long, events array<string>, timing string, meter int"


def test_each_pass(spark):
    abc = ["a", "b", "c"]
    ours = [(0, "S", 1, abc, "t", 5), (0, "S", 2, abc, "t", 9), (0, "S", 3, ["x"], "t", 7), (0, "S", 4, ["p", "q", "r"], "t", 20), (0, "S", 5, ["k"], "t", 12), (0, "S", 6, None, "t", 1), (0, "D", 7, abc, "t", 5)]
    theirs = [(0, "S", 11, abc, "u", 6), (0, "S", 12, abc, "t", 6), (0, "S", 13, ["y"], "t", 7), (0, "S", 14, ["q", "r", "p", "s"], "t", 1), (0, "S", 15, ["m"], "t", 14), (0, "S", 16, ["n"], "t", 30), (1, "S", 17, abc, "t", 5)]
    got = sorted(map(tuple, pairing.pair_passes(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(theirs, SCHEMA), ["file"]).select("file", "family", "rung", "ours", "theirs").collect()), key=repr)
    assert got == expected(ours, theirs)
    assert {(r[2], r[3], r[4]) for r in got if r[0] == 0} >= {("identical", 1, 12), ("same_events", 2, 11), ("same_meter", 3, 13), ("similar", 4, 14), ("near_meter", 5, 15), ("left", 6, None), ("left", 7, None)}


def test_passes_equal_greedy_choosing(spark):
    rng = random.Random(6)
    rows = lambda base: [(rng.randrange(12), rng.choice("SD"), base + k, rng.choice([None, [], *([rng.sample("abcdefgh", rng.randrange(1, 6))] * 9)]), rng.choice("tu"), rng.randrange(1, 12)) for k in range(120)]
    ours, theirs = rows(0), rows(1000)
    got = pairing.pair_passes(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(theirs, SCHEMA), ["file"]).select("file", "family", "rung", "ours", "theirs")
    assert sorted(map(tuple, got.collect()), key=repr) == expected(ours, theirs)
    assert {r.rung for r in got.collect()} == {*pairing.RUNGS, "left"}
    nothing = spark.createDataFrame([], SCHEMA)
    assert pairing.pair_passes(nothing, nothing, ["file"]).count() == 0


def test_query_and_its_plan(spark, sf):
    ours, theirs = plans.block_inputs(spark, sf)
    take = lambda df: [tuple(r) for r in df.select("cust", "family", "block", "events", "timing", "meter").collect()]
    got = plans.pair_passes(spark, sf).select("cust", "family", "rung", "ours", "theirs").collect()
    assert sorted(map(tuple, got), key=repr) == expected(take(ours), take(theirs))
    plan = pairing.similar_sets(ours, theirs, ["cust", "family"])._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_item" in plan


def test_equal_keys_meet_in_one_table(spark):
    """A pass over equal keys joins nothing; null families and keys pair with nothing."""
    state = [("S", 0, 1, ["a"], 5), ("S", 0, 2, ["a"], 5), ("S", 0, 3, ["b"], 5), ("S", 1, 11, ["c"], 5), ("S", 1, 12, ["a"], 5), ("S", 1, 13, None, 5), ("S", 1, 14, ["a"], None), (None, 0, 4, ["a"], 5), (None, 1, 15, ["a"], 5), ("S", 0, 5, ["a"], None)]
    rows = spark.createDataFrame([(*r, None, None) for r in state], "family string, _side int, block long, events array<string>, meter int, rung string, _with long")
    once = pairing.equal_ranks_beside(rows, ["family"], "one", F.col("meter"))
    assert "Join" not in once._jdf.queryExecution().optimizedPlan().toString()
    twice = pairing.equal_ranks_beside(once, ["family"], "two", F.col("family"))
    got = {r.block: (r.rung, r._with) for r in twice.collect()}
    assert got == {1: ("one", 11), 11: ("one", 1), 2: ("one", 12), 12: ("one", 2), 3: ("two", 14), 14: ("two", 3), 4: (None, None), 15: (None, None), 13: (None, None), 5: (None, None)}
