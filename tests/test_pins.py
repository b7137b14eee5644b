"""Pinned holds, tiles with pins, heights and the fine tempo against plain Python."""

import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from stepwise.operators import intervals, pins, signals
from stepwise.plans import pins as plans

from .conftest import rows

BY = ["series"]


def pinned(holds, steps, beats, tempo, unit, tolerance, ahead=8):
    """holds {name: (head, tail)} and beats in 1/unit, steps [(from, to or None, rate)], point by point."""
    xs, ys = [x for x, _ in tempo], [y for _, y in tempo]

    def time(x):
        if len(xs) == 1:
            return ys[0]
        k = min(max(np.searchsorted(xs, float(x), "right") - 1, 0), len(xs) - 2)
        return ys[k] + (ys[k + 1] - ys[k]) / (xs[k + 1] - xs[k]) * (float(x) - xs[k])

    def points(lo, hi):
        """Lattice points in (lo, hi]."""
        out = set()
        for a, b, rate in steps:
            if rate > 0:
                out |= {p for k in range(int(lo * rate // unit), int(hi * rate // unit) + 2) if lo < (p := Fraction(k * unit, rate)) <= hi and p >= a and (b is None or p < b)}
        return out

    found = {}
    for name, (head, tail) in holds.items():
        mine = points(head, tail)
        own = sum(1 for p in mine if p not in beats and not any(o != name and a < p <= b for o, (a, b) in holds.items()))
        later = points(tail, tail + ahead * unit)
        early = time(tail) - time(max(mine, default=head))
        late = time(min(later)) - time(tail) if later else 9.0
        found[name] = (own, early, late, own > 0, own > 0 and early < tolerance and late < tolerance)
    return found


def found_pins(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.series, {})[r.hold] = (r.own, r.early, r.late, r.state_pinned, r.tail_pinned)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for key, mine in want.items():
        assert got[key].keys() == mine.keys()
        for name, (own, early, late, state, tail) in mine.items():
            g = got[key][name]
            assert (g[0], g[3], g[4]) == (own, state, tail) and g[1:3] == pytest.approx((early, late), abs=1e-9), (key, name)


def test_holds_that_the_count_pins(spark):
    rng, series = random.Random(3), {}
    series[0] = ({1: (0, 24), 2: (12, 24), 3: (31, 32), 4: (48, 60)}, [(0, None, 4)], {51}, [(0, 0.0), (12, 0.5)])
    for k in range(1, 30):
        cuts = sorted({0, *(rng.randrange(1, 200) for _ in range(3))})
        steps = [(a, b, rng.randrange(0, 7)) for a, b in zip(cuts, [*cuts[1:], None], strict=True)]
        holds = {n: (a, a + rng.randrange(1, 40)) for n, a in enumerate(rng.randrange(0, 200) for _ in range(rng.randrange(1, 8)))}
        series[k] = (holds, steps, {rng.randrange(0, 240) for _ in range(30)}, [(t, t / 24 + 0.01 * n) for n, t in enumerate(sorted(rng.sample(range(240), 4)))])
    make = lambda data, schema: spark.createDataFrame(data, f"series int, {schema}")
    holds = make([(k, n, *h) for k, s in series.items() for n, h in s[0].items()], "hold long, head long, tail long")
    steps = make([(k, *x) for k, s in series.items() for x in s[1]], "b0 long, b1 long, value long")
    beats = make([(k, x) for k, s in series.items() for x in s[2]], "beat long")
    tempo = make([(k, *x) for k, s in series.items() for x in s[3]], "t long, y double")
    got = found_pins(pins.pinned_holds(holds, steps, beats, tempo, BY, 12, 0.06))
    want = {k: pinned(*s, 12, 0.06) for k, s in series.items()}
    same(got, want)
    assert got[0][1][0] == 4 and not got[0][2][3]  # beats 1/4 to 1 are its own, the rest is shared; the second has none
    assert not got[0][3][3]  # it has no point inside: a tap would count the same
    assert {t for m in want.values() for _, _, _, _, t in m.values()} == {True, False}


def test_pinned_query(spark, sf):
    by = lambda df: _by(df)
    holds, steps, beats, tempo = map(by, plans.pin_inputs(spark, sf))
    got = found_pins(plans.pinned_holds(spark, sf))
    want = {k: pinned({n: (a, b) for n, a, b in v}, [tuple(x) for x in steps.get(k, [])], {b for b, in beats.get(k, [])}, sorted(tempo[k]), 12, 0.05) for k, v in holds.items() if k in tempo}
    same({k: v for k, v in got.items() if k in tempo}, want)
    kinds = plans.watched(spark, sf).collect()
    assert {r.kind for r in kinds} == {"jack", "short_hold", "pinned_tail"} and max(r.n for r in kinds) > 1
    tails = sorted(((-sum(x[4] for x in v.values()), k) for k, v in got.items()))[:15]
    assert sorted((-r.n, r.series) for r in kinds if r.kind == "pinned_tail") == [t for t in tails if t[0]]


def _by(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r[0], []).append(tuple(r)[1:])
    return out


def test_jacks_and_short_holds(spark):
    notes = spark.createDataFrame([("a", 0, 0.0), ("a", 0, 0.1), ("a", 1, 0.2), ("a", 0, 0.3), ("b", 0, 0.0), ("b", 0, 0.25)], "series string, col int, t double")
    holds = spark.createDataFrame([("a", 1, 0.0, 0.2), ("b", 1, 0.0, 0.25), ("b", 2, 1.0, 1.1), ("b", 3, 2.0, 2.1)], "series string, hold int, head double, tail double")
    pinned_ = spark.createDataFrame([("a", True), ("b", False)], "series string, tail_pinned boolean")
    assert rows(pins.watched(notes, holds, pinned_, "series"), "kind", "series", "n") == [("jack", "a", 2), ("pinned_tail", "a", 1), ("short_hold", "a", 1), ("short_hold", "b", 2)]


def test_pins_replace_tiles_and_earlier_pins(spark):
    tiles = spark.createDataFrame([(0, 0.0, 1.0), (0, 1.0, 2.0), (0, 2.0, 2.02), (0, 2.02, 3.0)], "series int, t0 double, t1 double")
    some = spark.createDataFrame([(0, 1.0, 1.5, 7, 1), (0, 1.4, 1.8, 8, 2), (0, 2.9, 2.9, 3, 3)], "series int, t0 double, t1 double, value int, rank int")
    got = pins.replace_tiles(tiles, some, BY, 1.0)
    assert rows(got, "t0", "t1", "pinned") == [(0.0, 1.0, None), (1.4, 1.8, 8), (2.9, 2.9, 3)]  # a pin of no length replaces the tile around it, too


def test_tiles_move_to_the_ends_of_holds(spark):
    spans = spark.createDataFrame([(0, 0.0, 10.0)], "series int, s double, e double")
    holds = spark.createDataFrame([(0, 2.5, 3.2), (0, 5.0, 9.0)], "series int, head double, tail double")
    got = intervals.tile_snapped(spans, holds, BY, 3.0)
    assert rows(got, "t0", "t1") == [(0.0, 3.2), (3.2, 5.0), (5.0, 9.0), (9.0, 10.0)]


def test_tempo_and_a_beat(spark):
    rng = random.Random(4)
    truth = 60 / 128.3717
    t = sorted(0.31 + truth * rng.choice([0, 1, 2, 3, 0.5, 1.5, 2.25]) + 4 * truth * k for k in range(60))
    frame = spark.createDataFrame([(0, x) for x in t], "series int, t double")
    got = pins.tempo_and_origin(frame, BY, spark.createDataFrame([(0, 128.37)], "series int, bpm double")).first()
    bpm, strength, origin = plain_tempo(np.array(t), 128.37)
    assert got.bpm == pytest.approx(bpm, abs=1e-9) and got.strength == pytest.approx(strength) and got.origin == pytest.approx(origin, abs=1e-9)
    assert abs(bpm - 128.3717) <= 0.0005 and abs((got.origin - 0.31) / truth - round((got.origin - 0.31) / truth)) < 0.02


def plain_tempo(t, coarse):
    tries = [coarse - 0.02 + 0.0005 * k for k in range(80)]
    power = [round(float(abs(np.exp(2j * np.pi * t * b * 12 / 60).mean())), 9) for b in tries]
    bpm = tries[int(np.argmax(power))]
    step = 60 / bpm / 12
    start = np.angle(np.exp(2j * np.pi * t / step).mean()) / (2 * np.pi) * step
    places = np.round((t - start) / step).astype(int)
    votes = [sum(pins.WEIGHT.get(int(p - k) % 12, 0) for p in places) for k in range(12)]
    return bpm, max(power), start + int(np.argmax(votes)) * step


def test_tempo_query(spark, sf):
    t, coarse = map(_by, plans.tempo_inputs(spark, sf))
    got = {r.series: r for r in plans.tempo_and_origin(spark, sf).collect()}
    assert got.keys() == coarse.keys()
    for key, (((bpm),),) in coarse.items():
        want = plain_tempo(np.array([x for x, in t[key]]), bpm)
        assert (got[key].bpm, got[key].strength) == pytest.approx(want[:2], abs=2e-6) and got[key].origin == pytest.approx(want[2], abs=2e-6)


#: Series whose maxima differ if lower * (1 - part) is rounded before upper * part is added, and how many each has.
TIED = {0: ([105, 127, 296, 246, 272, 235], 2), 1: ([210, 235, 75, 125, 28, 271], 2), 2: ([18, 244, 282, 210, 234, 191], 1), 3: ([24, 140, 251, 172, 190, 110], 1)}


def test_equal_rises_are_equal_as_in_the_sql(spark):
    """DuckDB's percentile decides which neighbours are equal, to the last bit."""
    signal = spark.createDataFrame([(s, i, v) for s, (values, _) in TIED.items() for i, v in enumerate(values)], "series int, frame int, v long")
    assert rows(pins.local_heights(signal, BY), "series", "n") == [(s, n) for s, (_, n) in TIED.items()]
    db = duckdb.connect()
    db.execute("CREATE TABLE s (series INTEGER, frame INTEGER, v BIGINT)")
    rng = random.Random(3)
    values = [(s, i, rng.randrange(500)) for s in range(40) for i in range(50)]
    db.executemany("INSERT INTO s VALUES (?, ?, ?)", values)
    want = db.execute("SELECT series, frame, v - quantile_cont(v, 0.3) OVER (PARTITION BY series ORDER BY frame ROWS 30 PRECEDING) FROM s").fetchall()
    got = signals.rises(spark.createDataFrame(values, "series int, frame int, v long"), BY, thresh=-1000, around=0)
    assert rows(got, "series", "frame", "rise") == sorted(want, key=repr)
    empty = signals.rises(spark.createDataFrame([(0, 0, None), (0, 1, 4), (0, 2, None)], "series int, frame int, v long"), BY, thresh=-1, around=0)
    assert rows(empty, "frame", "rise") == [(1, 0.0)]
