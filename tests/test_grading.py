"""The gate, random rules and packets against plain Python."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from stepwise.operators import grading
from stepwise.plans import grading as plans

from .conftest import rows

CHARTS = "chart int, split string, pristine boolean, base int, expected int, up_base int, noted boolean, pack int"


def judged(per, delta, charts, catalog, clusters):
    """The gate's verdict on one rule; per: {(kind, name): matching holds}, clusters under kind 'x'."""

    def counts(scope):
        r = Counter()
        packs = set()
        for name, split, pristine, base, want, up, noted, pack in charts:
            if split not in scope:
                continue
            v = base + delta * per.get(("c", name), 0)
            u = None if up is None else up + delta * per.get(("u", name), 0)
            if base == want != v:
                r["pristine" if pristine else "excused" if u == want else "fitted"] += 1
            if base != want == v:
                r["fixes"] += 1
                if noted:
                    r["noted"] += 1
                    packs.add(pack)
        r["catalog"] = sum(1 for name, split, want in catalog if split in scope and per.get(("k", name)))
        r["lost"] = sum(1 for name, split, ticks, price in clusters if split in scope and ticks == price and per.get(("x", name)))
        r["packs"] = len(packs)
        return r

    tune, sealed, whole = counts({"tune"}), counts({"sealed"}), counts({"tune", "sealed"})
    hard = lambda r: not (r["pristine"] or r["fitted"] or r["catalog"] or r["lost"])
    a = hard(tune) and tune["noted"] >= 1 and tune["fixes"] > tune["excused"]
    b = hard(sealed) and hard(whole) and not sealed["excused"] and sealed["fixes"] >= 1 and whole["noted"] >= 3 and whole["packs"] >= 2
    return a, b, a and b, whole["fixes"], whole["pristine"] + whole["fitted"] + whole["excused"] + whole["catalog"]


def every_rule(holds, names, sampled, charts, catalog, clusters):
    out = {}
    features = [dict(zip(names, h[3:], strict=True)) for h in holds]
    for level in (1, 2, 3):
        for some in combinations(names, level):
            for values in {tuple(f[n] for n in some) for f in features}:
                rule = "&".join(f"{n}={v}" for n, v in zip(some, values, strict=True))
                if level == 3 and rule not in sampled:
                    continue
                per = Counter()
                for h, f in zip(holds, features, strict=True):
                    if all(f[n] == v for n, v in zip(some, values, strict=True)):
                        per[h[0], h[1]] += 1
                        if h[0] == "c" and h[2] is not None:
                            per["x", h[2]] += 1
                hits = sum(n for (k, _), n in per.items() if k != "x")
                for delta in (1, -1):
                    out[rule, delta] = (hits, *judged(per, delta, charts, catalog, clusters))
    return out


def test_random_rules_equal_counting_one_by_one(spark):
    rng, names = random.Random(3), ["a", "b", "c", "d"]
    charts, holds = [], []
    for k in range(80):
        n = rng.randrange(0, 5)
        charts.append((k, rng.choice(["tune", "tune", "sealed"]), rng.random() < 0.1, n, n + rng.choice([1, 1, 1, 0, -1]), rng.choice([None, n, n - 1]), rng.random() < 0.8, rng.randrange(3)))
        for kind in ("c", "u") if charts[-1][5] is not None else ("c",):
            holds += [(kind, k, rng.choice([None, k]) if kind == "c" else None, *(min(rng.randrange(9), m) for m in (7, 5, 3, 1))) for _ in range(n)]
    catalog = [(k, rng.choice(["tune", "sealed"]), 2) for k in range(100, 104)]
    holds += [("k", k, None, *(rng.randrange(m) for m in (8, 6, 4, 2))) for k, _, _ in catalog]
    clusters = [(c[0], c[1], 3, rng.choice([4, 4, 3])) for c in charts]
    frame = spark.createDataFrame
    args = frame(charts, CHARTS), frame(catalog, "chart int, split string, expected int"), frame(clusters, "cluster int, split string, ticks int, price int")
    got = {(r.rule, r.delta): tuple(r)[2:] for r in grading.null_gate(frame(holds, f"kind string, chart int, cluster int, {', '.join(f'{n} int' for n in names)}"), names, *args, 60, "s").collect()}
    sampled = {r for r, _ in got if r.count("&") == 2}
    assert len(sampled) == 60
    assert got == every_rule(holds, names, sampled, charts, catalog, clusters)
    assert sum(v[1] for v in got.values()) > 0


def test_a_rule_that_is_right_passes_and_one_break_stops_it(spark):
    frame = spark.createDataFrame
    charts = [(k, "tune" if k < 4 else "sealed", False, 5, 6, None, True, k % 2) for k in range(6)]
    holds = [("c", k, None, 1) for k in range(6)]
    none = frame([], "chart int, split string, expected int"), frame([], "cluster int, split string, ticks int, price int")
    run = lambda c, h: {(r.rule, r.delta): (r.tune, r.full, r.fixes, r.breaks) for r in grading.null_gate(frame(h, "kind string, chart int, cluster int, f int"), ["f"], frame(c, CHARTS), *none, 0, "s").collect()}
    assert run(charts, holds) == {("f=1", 1): (True, True, 6, 0), ("f=1", -1): (False, False, 0, 0)}
    broken = [*charts, (9, "sealed", True, 7, 7, None, True, 0)]
    assert run(broken, [*holds, ("c", 9, None, 1)])["f=1", 1] == (True, False, 6, 1)
    excused = [*charts, (9, "tune", False, 7, 7, 6, True, 0)]
    assert run(excused, [*holds, ("c", 9, None, 1), ("u", 9, None, 1)])["f=1", 1] == (True, True, 6, 1)


def test_random_rules_of_the_query(spark, sf):
    holds, charts, catalog, clusters = ([tuple(r) for r in df.collect()] for df in plans.grade_inputs(spark, sf))
    got = {(r.rule, r.delta): tuple(r)[2:] for r in plans.null_gate(spark, sf).collect()}
    some = {r for r, _ in got if r.count("&") == 2}
    few = set(sorted(some)[:15])
    names = list(plans.NAMES)
    want = every_rule([h for h in holds], names, few, charts, catalog, clusters)
    assert {k: v for k, v in got.items() if k[0].count("&") < 2 or k[0] in few} == want
    assert len(some) == 200 and not any(v[3] for v in got.values())


def test_alike_charts_are_graded_as_one(spark):
    """A thousand charts whose counts differ from what is expected alike make no more rows for the gate than ten."""
    def units(n):
        rows = spark.createDataFrame([("c", k, None, p) for k in range(n) for p in (1, 1, 6)] + [("u", k, None, 2) for k in range(n)], "kind string, chart int, cluster int, packed long")
        charts = spark.createDataFrame([(k, "tune", k % 2 == 0) for k in range(n)], "chart int, split string, noted boolean")
        return grading._matched(rows, "chart", {"c": grading.F.lit(True), "u": grading.F.col("noted")}, charts, [(3, None), (7, np.array([6]))])

    for n in (10, 1000):
        half = n // 2
        want = [(3, 1, 2, 0, "tune", noted, half) for noted in (False, True)] + [(3, 2, 1, u, "tune", u == 1, half) for u in (0, 1)] + [(7, 6, 1, 0, "tune", noted, half) for noted in (False, True)]
        assert rows(units(n)) == sorted(want, key=repr)


@pytest.mark.parametrize("wide", [0, 1 << 60])
def test_tallies(wide):
    rng = np.random.default_rng(3)
    keys, values = np.stack((rng.integers(0, 5, 400), rng.integers(0, 7, 400) + wide, rng.integers(0, 3, 400))), rng.integers(0, 9, (2, 400))
    got, sums = grading._tally(keys, values)
    want = {}
    for k, v in zip(keys.T.tolist(), values.T.tolist(), strict=True):
        want[tuple(k)] = [a + b for a, b in zip(want.get(tuple(k), [0, 0]), v, strict=True)]
    assert dict(zip(map(tuple, got.T.tolist()), sums.T.tolist(), strict=True)) == want and got.shape[1] == len(want)
    assert grading._tally(keys[:, :0], values[:, :0])[0].shape == (3, 0)


@pytest.mark.parametrize("n,pool", [(100, 7), (100, 1000), (19, 3), (40, 0), (0, 5)])
def test_packets(spark, n, pool):
    items = spark.createDataFrame([(1000 + k, k) for k in range(n)], "item int, pos long")
    seeds = spark.createDataFrame([(k * 11, k) for k in range(pool)], "seed int, n long")
    got = grading.draw_packets(items, seeds, "salt").collect()
    by = {}
    for r in got:
        by.setdefault(r.packet, []).append(r)
    assert sorted(int(r.item) for r in got if r.kind == "real") == list(range(1000, 1000 + n))
    drawn = []
    for p in sorted(by):
        real, mine = [r for r in by[p] if r.kind == "real"], [r.item for r in by[p] if r.kind == "seed"]
        assert len(mine) == len(set(mine)) == min(pool, max(1, -(-len(real) // 4))) and len(real) <= 19
        assert [r.slot for r in sorted(by[p], key=lambda r: r.iid)] == list(range(1, len(by[p]) + 1))
        drawn += mine
    uses = Counter(drawn)
    assert not uses or max(uses.values()) - (min(uses.values()) if len(uses) == pool else 0) <= 1  # none again before all


def test_packets_are_refused(spark):
    items = spark.createDataFrame([(k, k) for k in range(500)], "item int, pos long")
    seeds = spark.createDataFrame([(k, k) for k in range(50)], "seed int, n long")
    with pytest.raises(ValueError, match="packets"):
        grading.draw_packets(items, seeds, "s")
    with pytest.raises(ValueError, match="would hold"):
        grading.draw_packets(items, seeds, "s", per_packet=60, most_packets=None)
    plan = grading.draw_packets(items, seeds, "s", most_packets=None)._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert rows(grading.draw_packets(items, seeds, "s", most_packets=None).filter("packet = 26 AND kind = 'real'"), "item")
