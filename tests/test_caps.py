"""Claimed holds, short caps and off-speed notes against plain Python."""

from statistics import mean, median

import pytest

from stepwise.operators import caps
from stepwise.plans import caps as plans

from .conftest import rows

BY = ["series"]


def _by(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["series"], []).append(r)
    return out


def lag_of(notes, gap):
    speeds = [-n.v for n in notes if n.v]
    return gap / median(speeds) if speeds and median(speeds) else 0.06


def claimed(notes, rails, lane, lag, most, least, share, inside):
    held, owner = {}, {}
    for r in sorted(rails, key=lambda r: r.rail):
        near = [n for n in notes if n.col == r.col and abs(r.a + lag - n.t) <= min(most, max(least, share * (r.b - r.a)))]
        if near:
            head = min(near, key=lambda n: (abs(r.a + lag - n.t), n.t, n.id))
            mine = sorted((x.t, x.occ) for x in lane if x.col == r.col)
            seen = [o for t, o in mine if r.a <= t < r.b] or [o for t, o in mine if t >= r.a][:1]
            held[head.id] = (r.b + lag, r.b - r.a, mean(seen) if seen else 0.0)
            owner[r.rail] = head.id
    out = {}
    for n in notes:
        if not any(r.rail in owner and owner[r.rail] != n.id and r.col == n.col and r.a + lag + inside[0] < n.t < r.b + lag + inside[1] for r in rails):
            out[n.id] = held.get(n.id, (None, None, None))
    return out


def test_claims_of_the_query(spark, sf):
    notes, rails, lane = map(_by, plans.note_inputs(spark, sf))
    got = {}
    for r in plans.claim_holds(spark, sf).collect():
        got.setdefault(r.series, {})[r.id] = (r.hold_end, r.rail_len, r.rail_occ)
    for key, mine in notes.items():
        want = claimed(mine, rails.get(key, []), lane.get(key, []), lag_of(mine, 60.0), 9.0, 2.0, 0.6, (0.5, 2.0))
        assert got[key].keys() == want.keys()
        for name, values in want.items():
            assert got[key][name] == (values if values[0] is None else pytest.approx(values, abs=1e-5)), (key, name)
    kept = sum(map(len, got.values()))
    assert kept < sum(map(len, notes.values())) and any(v[0] is not None for m in got.values() for v in m.values())


def test_a_rail_belongs_to_one_note_and_swallows_only_if_opened(spark):
    notes = spark.createDataFrame([(0, 0, 1, 1.0), (0, 0, 2, 1.3), (0, 0, 3, 5.2), (0, 1, 4, 1.2)], "series int, col int, id int, t double")
    rails = spark.createDataFrame([(0, 0, 1, 0.96, 1.36), (0, 0, 2, 4.0, 6.0)], "series int, col int, rail int, a double, b double")
    lane = spark.createDataFrame([(0, 0, 1.0, 0.5), (0, 0, 1.2, 1.0), (0, 0, 1.36, 0.0)], "series int, col int, t double, occ double")
    lags = spark.createDataFrame([(0, 0.04)], "series int, lag double")
    got = caps.claim_holds(notes, rails, lane, lags, BY, 1.0)
    assert rows(got, "id", "rail_len", "rail_occ") == [(1, pytest.approx(0.4), 0.75), (3, None, None), (4, None, None)]


def kept(notes, bars, lag, gap, head, cap, speed, opens, bar, closes):
    known = [n.q for n in notes if n.q is not None]
    m, drop = median(known) if known else None, set()
    for col in {n.col for n in notes}:
        mine = sorted((n for n in notes if n.col == col), key=lambda n: (n.t, n.id))
        for u, v in zip(mine, mine[1:]):
            if u.hold_end is not None or u.id in drop or not gap[0] <= v.t - u.t <= gap[1] or u.q is None or v.q is None:
                continue
            if not head[0] * m <= u.q < head[1] * m or v.q >= cap * m or not u.v or abs(v.v / u.v - 1) > speed:
                continue
            if any(b.col == col and abs(b.a + lag - u.t) <= opens and bar[0] <= b.b - b.a <= bar[1] and abs(b.b + lag - v.t) <= closes for b in bars):
                drop.add(v.id)
    return {n.id for n in notes} - drop


def test_short_caps_of_the_query(spark, sf):
    notes, rails, _ = plans.note_inputs(spark, sf)
    held = _by(notes.selectExpr("*", "CASE WHEN id % 5 = 0 THEN t + 1 END AS hold_end"))
    bars, got, dropped = _by(rails), {}, 0
    for r in plans.short_caps(spark, sf).collect():
        got.setdefault(r.series, set()).add(r.id)
    for key, mine in held.items():
        assert got.get(key, set()) == kept(mine, bars.get(key, []), lag_of(mine, 60.0), *plans.CAPS), key
        dropped += len(mine) - len(got.get(key, set()))
    assert dropped > 3


def test_caps_in_a_row_go_by_turns(spark):
    notes = spark.createDataFrame([(0, 0, k, k * 0.1, -100.0, 0.8, None) for k in range(5)] + [(0, 1, 9, 0.0, -100.0, 1.0, None)] * 1, "series int, col int, id int, t double, v double, q double, hold_end double")
    bars = spark.createDataFrame([(0, 0, k * 0.1, k * 0.1 + 0.1) for k in range(5)], "series int, col int, a double, b double")
    lags = spark.createDataFrame([(0, 0.0)], "series int, lag double")
    got = caps.drop_short_caps(notes, bars, lags, BY, 0.5, (0.05, 0.12), (0.7, 1.1), 1.1, 0.1, 0.02, (0.05, 0.15), 0.02)
    assert rows(got, "id") == [(0,), (2,), (4,), (9,)]


def test_retiming_of_the_query(spark, sf):
    notes = _by(plans.note_inputs(spark, sf)[0])
    got = {}
    for r in plans.retime(spark, sf).collect():
        got.setdefault(r.series, {})[r.id] = (r.t, r.retimed)
    moved = 0
    for key, mine in notes.items():
        mine = sorted(mine, key=lambda n: (n.t, n.id))
        for x, n in enumerate(mine):
            m = median(-o.v for o in mine[max(0, x - 25) : x + 25])
            odd = m > 0 and n.frames <= 4 and abs(-n.v / m - 1) > 0.2
            want = n.mt + (n.yj - n.my) / -m if odd else n.t
            assert got[key][n.id] == (pytest.approx(want, abs=1e-5), odd)
            moved += odd
    assert moved > 3
