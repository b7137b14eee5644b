"""Many small files: what is started for each of them, how often they are opened, and that no writing changes them."""

import json
import os

from pyspark.sql import functions as F

from stepwise.plans import corpora
from stepwise.sources import corpus, files

from .conftest import rows


def scans(df, what):
    return df._jdf.queryExecution().optimizedPlan().toString().count(f"Relation [{what}")


def written(top):
    """Path below top -> bytes, of all files but Spark's own marks."""
    found = [os.path.join(p, f) for p, _, names in os.walk(top) for f in names if f != "_SUCCESS" and not f.endswith("_SUCCESS.crc")]
    return {os.path.relpath(f, top): open(f, "rb").read() for f in found}


def test_files_are_written_without_a_process_each(spark, tmp_path, monkeypatch):
    lines = spark.createDataFrame([(p, s, k, None if k == 1 else f"é{p}{s}{k}") for p in range(3) for s in range(20) for k in range(4)], "pack long, song long, k int, value string").repartition(3, "song").sortWithinPartitions("pack", "song", "k")
    corpora._write(spark, lines, ["pack", "song"], f"file:{tmp_path}/ours")
    ours = written(tmp_path / "ours")
    assert ours == {f"pack={p}/song={s}/part.txt": f"é{p}{s}0\n\né{p}{s}2\né{p}{s}3\n".encode() for p in range(3) for s in range(20)}, "no checksum files, nothing half done"
    monkeypatch.setattr(corpora, "_mounted", lambda spark, path: None)
    corpora._write(spark, lines, ["pack", "song"], f"file:{tmp_path}/sparks")
    sparks = {os.path.dirname(k): v for k, v in written(tmp_path / "sparks").items() if not k.endswith(".crc")}
    assert sparks == {os.path.dirname(k): v for k, v in ours.items()}


def test_only_mounted_folders_are_written_with_plain_calls(spark, tmp_path):
    assert corpora._mounted(spark, f"file:{tmp_path}/x") == f"{tmp_path}/x"
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shared.link./top", f"file://{tmp_path}")
    assert corpora._mounted(spark, "viewfs://shared/top/x") is None


def test_texts_are_repaired_without_python(spark, tmp_path):
    bad = b"#TITLE:\xff\xe2\x82;\r\n\xed\xa0\x80\xf4\x90\x80\x80\xc0\x80\xf0\x9f\x98\r"
    os.makedirs(tmp_path / "p" / "s")
    (tmp_path / "p" / "s" / "x.ssc").write_bytes(bad)
    got = corpus.read_corpus(spark, str(tmp_path))
    assert got.first().content == bad.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")
    assert "pythonUDF" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_folders_are_listed_by_a_few_tasks(spark, sf, tmp_path):
    for k in range(120):
        os.makedirs(tmp_path / f"series={k}")
        (tmp_path / f"series={k}" / "x.jsonl").write_text("[0.1, 5, 0.9]\n" if k % 3 else "[0.1, 5, 0.9]\n[0.2, 7\n")
    corpora.table(spark, sf, "region")
    spark.sparkContext.setJobGroup("listing", "")
    try:
        got = files.read_series_jsonl(spark, str(tmp_path))
        status = spark.sparkContext.statusTracker()
        tasks = sum(status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("listing") for s in status.getJobInfo(j).stageIds)
        assert 0 < tasks <= 4 * spark.sparkContext.defaultParallelism
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert got.count() == 80 and scans(got, "value") == 1, "files are opened once"


def test_ledgers_are_read_once(spark, tmp_path):
    body = {"status": "S", "skin": "k", "charts": {"a": {"expected": 5, "side": "1p", "verdict": "ok"}, "b": None}}
    for name, value in {"map": {"v1": body, "v2": None, "v3": {"status": "T"}}, "list": [{"vid": "w1", **body}, None, {"vid": "w3", "charts": {}}], "none": [], "empty": {}}.items():
        (tmp_path / f"{name}.json").write_text(" " * (name == "list") + json.dumps(value))
    (tmp_path / "broken.json").write_text('{"v9": ')
    got = files.read_ledger(spark, str(tmp_path))
    one = lambda v: [(v, "S", "k", "a", "1p", 5, "ok"), (v, "S", "k", "b", None, None, None)]
    none = (None,) * 4
    assert rows(got, "vid", "status", "skin", "chart", "side", "expected", "verdict") == sorted([*one("v1"), ("v2", None, None, *none), ("v3", "T", None, *none), *one("w1"), (None, None, None, *none), ("w3", None, None, *none)], key=repr)
    assert scans(got, "value") == 1


def test_chart_tables_are_as_sparks_own(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(corpora, "_folder", lambda spark, name: f"file:{tmp_path}/{name}")
    corpora.chart_meta(spark, sf)
    ours = written(tmp_path / "charts")
    assert ours and not any(k.endswith(".crc") for k in ours)
    rows_ = spark.read.option("recursiveFileLookup", "true").option("header", "true").option("escape", '"').csv(f"file:{tmp_path}/charts").withColumn("song", F.regexp_extract(F.input_file_name(), r"song=(\d+)", 1).cast("long"))
    one = rows_.filter(F.col("song") == rows_.agg(F.min("song")).first()[0]).drop("song").withColumn("Time", F.col("Time").cast("long")).withColumn("Beat", F.col("Beat").cast("double"))
    one.coalesce(1).write.option("header", True).option("escape", '"').csv(f"file:{tmp_path}/again")
    again = [v for k, v in written(tmp_path / "again").items() if k.endswith(".csv")]
    assert again[0] in ours.values()
