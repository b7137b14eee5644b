"""Parsing of a small corpus and of the other file kinds."""

import hashlib
import json
import math
import random
import zipfile
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stepwise.sources import corpus, files

from .conftest import rows

HEAD = "#TITLE:A: B;\n#BPMS:0.0=200.0\n,96.0=133.3\n,0.0=180,x=1,5=;\n#TICKCOUNTS:0=4;\n"
ONE = "#NOTEDATA:;\n#STEPSTYPE:pump-single;\n#DESCRIPTION:S1;\n#METER:1;\n#METER:9;\n#NOTES:\n10000 // tap\n00000\n02000\n{2|n|1|0}0000\n,\n03000\n00F0M\n00000\n00000\n,\n"
ONE += "\n".join(["00001", *["00000"] * 6]) + "\n,\n;\n"
TWO = "#NOTEDATA:;\n#STEPSTYPE:pump-halfdouble;\n#TICKCOUNTS:0=2,4=8;\n#NOTES:\n000010\n000000\n000000\n000000\n;\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("corpus")
    for name, text in (("a", HEAD + ONE + TWO), ("b", (HEAD + ONE + TWO).replace("\n", "\r\n"))):
        (top / "Pack" / name).mkdir(parents=True)
        (top / "Pack" / name / "x.ssc").write_bytes(text.encode() + b"\n")
    (top / "Pack" / "b" / "y.ssc").write_bytes(b"#TITLE:\xff;\n")
    return str(top)


@pytest.fixture(scope="module")
def blocks(spark, folder):
    return corpus.parse_tags(corpus.split_blocks(corpus.read_corpus(spark, folder))).cache()


def test_line_ends_make_no_difference(blocks):
    assert rows(blocks.groupBy("block").agg(F.countDistinct("block_sha"), F.countDistinct("header_sha"), F.count("*"))) == [(0, 1, 1, 2), (1, 1, 1, 2)]


def test_bad_bytes_are_replaced(spark, folder):
    assert corpus.read_corpus(spark, folder).filter("path LIKE '%y.ssc'").first().content == "#TITLE:�;\n"


def test_tags_inherit_and_first_wins(blocks):
    one, two = blocks.filter("song = 'a'").orderBy("block").collect()
    assert (one.tags["TITLE"], one.tags["METER"], one.tags["TICKCOUNTS"], two.tags["TICKCOUNTS"]) == ("A: B", "1", "0=4", "0=2,4=8")


def test_schedule(blocks):
    got = rows(corpus.parse_schedule(blocks.filter("song = 'a' AND block = 0"), "BPMS", ["song", "block"]), "beat", "value")
    assert got == [(0.0, 180.0), (96.0, 133.3)]


def test_notes(blocks):
    notes = corpus.explode_notes(blocks.filter("song = 'a'"), ["block"])
    got = rows(notes.select("block", "beat.num", "beat.den", "col", "sym"))
    assert got == sorted([(0, 0, 1, 0, "1"), (0, 2, 1, 1, "2"), (0, 4, 1, 1, "3"), (0, 8, 1, 4, "1"), (1, 0, 1, 6, "1")], key=repr)
    assert rows(corpus.fake_notes(blocks.filter("song = 'a'"), ["block"]), "block", "col") == [(0, 0), (0, 2)]
    assert rows(corpus.judged_rows(notes, ["block"])) == [(0, 2), (1, 1)]


def test_beats_are_exact_fractions(spark):
    df = spark.createDataFrame([(2, 3, 7), (0, 0, 13), (1, 150, 197), (3, 4, 16)], "m int, r int, n int")
    got = [tuple(x.b) for x in df.select(corpus.beat_of(F.col("m"), F.col("r"), F.col("n")).alias("b")).collect()]
    assert got == [(68, 7), (0, 1), (1388, 197), (13, 1)]


def test_grid_round_trip(spark, blocks):
    notes = corpus.explode_notes(blocks.filter("song = 'a' AND block = 0"), ["block"])
    grid = corpus.render_grid(notes, ["block"], 5)
    text = ",\n".join(r.text for r in grid.orderBy("measure").collect())
    again = spark.createDataFrame([(0, {"NOTES": text})], "block int, tags map<string, string>")
    assert rows(corpus.explode_notes(again, ["block"])) == rows(notes)


def test_tails_give_way_to_the_next_head(spark):
    at = lambda n, d=1: (n, d)
    rows_ = [(0, at(0), 0, "2"), (0, at(2), 0, "3"), (0, at(2), 0, "1"), (0, at(1), 1, "2"), (0, at(49, 48), 1, "3"), (0, at(49, 48), 1, "2"), (0, at(3), 1, "3"), (0, at(0), 2, "2")]
    notes = spark.createDataFrame(rows_, "block int, beat struct<num: long, den: long>, col int, sym string")
    got = rows(corpus.give_way(notes, ["block"], 48).select("beat.num", "beat.den", "col", "sym"))
    assert got == sorted([(0, 1, 0, "2"), (95, 48, 0, "3"), (2, 1, 0, "1"), (1, 1, 1, "1"), (49, 48, 1, "2"), (3, 1, 1, "3"), (0, 1, 2, "1")], key=repr)
    text = corpus.render_grid(notes, ["block"], 3).first().text
    assert text is not None and sum(c != "0" for c in text.replace("\n", "")) == 7


def test_dump(spark, tmp_path):
    (tmp_path / "v.txt").write_text("0000aaaa-0000-0000-0000-00000000000a|u|c|\nbad|u|c|1\n0000aaaa-0000-0000-0000-00000000000b|u|c|7\nshort|row\n")
    got = rows(files.read_dump(spark, str(tmp_path / "v.txt"), ["id", "url", "channel", "n"], numbers=["n"], ids=["id"]), "id", "n")
    assert got == [("0000AAAA-0000-0000-0000-00000000000A", None), ("0000AAAA-0000-0000-0000-00000000000B", 7)]


def test_ledger_in_both_shapes(spark, tmp_path):
    body = {"status": "CERTIFIED", "t": 1.0, "skin": "x", "charts": {"A S1": {"expected": 5, "side": "1p", "verdict": "ok"}}}
    (tmp_path / "a.json").write_text(json.dumps({"v1": body}))
    (tmp_path / "b.json").write_text(json.dumps([{"vid": "v1", **body}]))
    a, b = (rows(files.read_ledger(spark, str(tmp_path / f"{n}.json"))) for n in "ab")
    assert a == b == [("v1", "CERTIFIED", "x", "A S1", "1p", 5, "ok")]
    assert files.read_ledger(spark, str(tmp_path / "absent.json")).isEmpty()


def test_one_bad_line_loses_the_file(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text("[0.1, 5, 0.9]\n[0.2, null, 0.5]\n")
    (tmp_path / "bad.jsonl").write_text("[0.1, 5, 0.9]\n[0.2, 7\n")
    assert rows(files.read_series_jsonl(spark, str(tmp_path)), "t", "v", "conf") == [(0.1, 5, 0.9), (0.2, None, 0.5)]
    good = (tmp_path / "good.jsonl").read_bytes()
    sidecar = lambda n: spark.createDataFrame([(str(tmp_path / "good.jsonl"), n, len(good), hashlib.sha256(good).hexdigest())], "path string, lines long, size long, sha256 string")
    assert files.read_series_jsonl(spark, str(tmp_path), sidecar(2)).count() == 2
    assert files.read_series_jsonl(spark, str(tmp_path), sidecar(3)).count() == 0


def test_chartstruct(spark, tmp_path):
    meta = json.dumps({"ssc_file": "x.ssc", "DESCRIPTION": "S1", "SONGTYPE": "ARCADE", "Hold ticks": [[1.0, 2.0, 3.6]]}).replace('"', '""')
    (tmp_path / "c.csv").write_text(f'Time,Beat,Line,Metadata\n0.5,1.0,`10000,"{meta}"\n0.75,1.5,`01000,\n')
    table, info = files.read_chartstruct(spark, str(tmp_path / "c.csv"))
    assert rows(table, "time", "beat", "line") == [(0.5, 1.0, "10000"), (0.75, 1.5, "01000")]
    assert info.first().ticks[0].n == 4 and info.first().description == "S1"


def test_archive_and_report(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("a.json", "{}")
        z.writestr("stepfiles/x.ssc", "text")
    got = files.read_archive(spark, str(tmp_path))
    assert rows(got, "name", "is_chart") == [("a.json", True), ("stepfiles/x.ssc", False)]
    files.write_report(got.select("name", "sha1"), str(tmp_path / "out"), ["name"])
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_grids_are_written_in_one_go(spark):
    """No map of cells inside a loop over cells, no union: a measure's text comes from its sorted cells, notes keep their partitioning."""
    rng = random.Random(4)
    cells = [(key, *place, rng.choice("12M")) for key in range(60) for place in sorted({(m * 96 + rng.randrange(96), rng.randrange(5)) for m in range(3) for _ in range(rng.randrange(12))})]
    cells = [(k, at, col, "1" if s == "2" else s) for k, at, col, s in cells]  # heads without tails become taps
    notes = spark.createDataFrame([(k, (Fraction(at, 24).numerator, Fraction(at, 24).denominator), col, s) for k, at, col, s in cells], "block int, beat struct<num: long, den: long>, col int, sym string")
    want = {}
    for k, at, col, s in cells:
        want.setdefault((k, at // 96), {})[at % 96, col] = s
    grid = corpus.render_grid(notes, ["block"], 5)
    got = {(r.block, r.measure): (r.rows, r.text) for r in grid.collect()}
    assert got.keys() == want.keys()
    for place, mine in want.items():
        n = math.lcm(4, *(Fraction(at, 96).denominator for at, _ in mine))
        assert got[place] == (n, "\n".join("".join(mine.get((r * 96 // n, c), "0") for c in range(5)) for r in range(n)))
    twice = corpus.render_grid(notes.unionByName(notes), ["block"], 5)
    assert {(r.block, r.measure): r.text for r in twice.collect()} == {k: t for k, (_, t) in got.items()}
    clash = spark.createDataFrame([(0, (0, 1), 0, "1"), (0, (0, 1), 0, "M"), (1, (1, 300), 0, "1")], notes.schema)
    assert rows(corpus.render_grid(clash, ["block"], 5), "block", "text") == [(0, None), (1, None)]
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "map_from_entries" not in plan and "sequence(1, 30" not in plan
