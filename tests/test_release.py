"""Every check of a release fails on its own planted defect, and on nothing else."""

import pytest

from stepwise.operators import release
from stepwise.plans import release as plans

from .conftest import rows

SEGMENTS = "array<struct<s: double, e: double, n: double>>"
KEY, STAR = "Bee_-_Ban_Ya_S17_ARCADE", "A*_-_B_D4_ARCADE"


def good():
    return {
        "release": [("r", "260911", "260911", "260910")],
        "entries": [(KEY, "Bee", "Ban/Ya", "S17", "ARCADE", r"C:\a\simfiles\X\bee.ssc", [(0.0, 1.0, 3.0), (2.0, 3.0, 4.0)]), (STAR, "A*", "B", "D4", "ARCADE", "simfiles/Y/a.ssc", None)],
        "table": [(KEY,), (STAR,)],
        "shipped": [("X/bee.ssc", "1"), ("Y/a.ssc", "2")],
        "tree": [("X/bee.ssc", "1"), ("Y/a.ssc", "2")],
        "repairs": [("Bee S17", KEY, 7), ("A D4", "A_-_B_D4_ARCADE", 0)],
        "derived": [(KEY, [(0.0, 1.00001, 3.0), (2.0, 3.0, 4.0)]), (STAR, [])],
        "ledger": [(KEY, 7)],
        "old": [(KEY,)],
    }


SCHEMAS = {
    "release": "name string, version string, stamp string, previous string", "entries": f"key string, title string, artist string, description string, songtype string, ssc_file string, segments {SEGMENTS}", "table": "name string",
    "shipped": "path string, sha string", "tree": "path string, sha string", "repairs": "chart string, key string, ticks long", "derived": f"key string, segments {SEGMENTS}", "ledger": "key string, ticks long", "old": "key string",
}


def checked(spark, given):
    got = release.release_checks(*(spark.createDataFrame(given[k], s) for k, s in SCHEMAS.items())).collect()
    assert {r.check for r in got} == set(release.CHECKS) and all(r.ok == (r.n_bad == 0) for r in got)
    return {r.check: (r.n_bad, r.samples) for r in got if not r.ok}


DEFECTS = {
    "version_decimal": ({"release": [("r", "26x", "26x", None)]}, "r"), "version_stamp": ({"release": [("r", "260912", "260911", "260910")]}, "r"), "version_grows": ({"release": [("r", "260911", "260911", "260911")]}, "r"),
    "table_only": ({"table": [(KEY,), (STAR,), ("T",)]}, "T"), "entry_only": ({"table": [(KEY,)]}, STAR), "steps_missing": ({"tree": [*good()["tree"], ("Z/z.ssc", "3")]}, "Z/z.ssc"),
    "steps_extra": ({"shipped": [*good()["shipped"], ("Z/z.ssc", "3")]}, "Z/z.ssc"), "steps_differ": ({"shipped": [("X/bee.ssc", "9"), ("Y/a.ssc", "2")]}, "X/bee.ssc"), "repair_missing": ({"repairs": [("gone", "G", 1)]}, "gone"),
    "repair_ticks": ({"repairs": [("Bee S17", KEY, 8)]}, "Bee S17"), "ticks_derived": ({"derived": [(KEY, [(0.0, 1.1, 3.0), (2.0, 3.0, 4.0)]), (STAR, [])]}, KEY), "ticks_ledger": ({"ledger": [(KEY, 6)]}, KEY), "dropped": ({"old": [(KEY,), ("O",)]}, "O"),
    "wrong_key": ({"entries": [(KEY, "Bees", *good()["entries"][0][2:]), good()["entries"][1]]}, KEY), "orphan_steps": ({"entries": [(*good()["entries"][0][:5], "simfiles/N/n.ssc", good()["entries"][0][6]), good()["entries"][1]]}, KEY),
}


def test_a_clean_release_passes(spark):
    assert checked(spark, good()) == {}


@pytest.mark.parametrize("check", release.CHECKS)
def test_each_defect_is_found(spark, check):
    change, name = DEFECTS[check]
    found = checked(spark, good() | change)
    assert found[check] == (1, [name]) and len(found) == 1


def test_defects_planted_in_the_query(spark, sf):
    parts = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey").collect()
    keys = {r[0] for r in parts}
    got = {r.check: r.n_bad for r in plans.release_checks(spark, sf).collect()}
    entries = {k for k in keys if k % 50 != 1 and k % 31} | ({31} & keys)
    plain = entries - {31}  # entry 31 has a name that isn't its own
    listed = {k for k in keys if k % 60 != 2}
    assert got["table_only"] == len(listed - plain) and got["entry_only"] == len(plain - listed) + (31 in keys)
    assert got["wrong_key"] == (31 in keys) and got["version_stamp"] == 1 and got["version_grows"] == got["version_decimal"] == 0
    assert got["repair_missing"] == sum(1 for k in keys if k % 20 == 0 and (k % 100 == 0 or k not in plain))
    assert got["repair_ticks"] == sum(1 for k in plain if k % 40 == 0 and k % 100)
    assert got["ticks_derived"] == sum(1 for k in plain if k % 33 == 0) + (31 in keys)
    assert got["ticks_ledger"] == sum(1 for k in plain if k % 27 == 0) and got["dropped"] == sum(1 for k in keys if k % 25 == 1 and k not in plain)
    paths = {(k % 40, k % 10) for k in keys}
    assert (got["steps_missing"], got["steps_extra"], got["steps_differ"]) == (sum(a == 7 for a, _ in paths), 1, sum(a == 3 for a, _ in paths))
    assert got["orphan_steps"] == sum(1 for k in entries if k % 40 == 7)


def test_the_other_half_of_a_split_picture(spark):
    charts = [("moves", "v", "Left", "old", None), ("half", "v", "Right", "v", None), ("set", "v", "Right", "v", "Right"), ("moves too", "v", "Right", "v", "Left"), ("elsewhere", "v", "Right", "w", None), ("whole", "v", None, "v", "Left"), ("other", "x", "Left", "x", None)]
    frame = spark.createDataFrame(charts, "chart string, best_source string, best_side string, source string, side string")
    moves = spark.createDataFrame([("moves", "v", "Left"), ("moves too", "v", "Right"), ("plain", "x", "")], "chart string, best_source string, best_side string")
    assert rows(release.partner_sides(moves, frame), "chart", "source", "side") == [("half", "v", "Right")]


def test_only_one_region_is_pinned(spark):
    regions = spark.createDataFrame([(0, 1, 0.0, 1.0), (0, 2, 2.0, 3.0)], "series int, region int, rs double, re double")
    pins = spark.createDataFrame([(0, 1, 0.2, 0.8, 5), (0, 2, 0.9, 2.1, 6), (0, 3, 1.1, 1.2, 7), (0, 4, 1.3, 1.4, 8)], "series int, pin int, s double, e double, value int")
    got = release.pin_regions(regions, pins, ["series"], 1.0)
    assert rows(got, "pin", "region", "matches") == [(1, 1, 1), (2, None, 2), (3, 1, 1), (4, None, 0)]
    assert rows(release.pinned_totals(got, ["series"]), "region", "value", "pins") == [(1, 12, 2)]
