"""Dumps, ledgers, scans, chart tables and archives; reports out."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: All files below a folder; names of folders (key=value) aren't made columns, which the driver would do one by one.
BELOW = {"recursiveFileLookup": "true"}
GUID = "^[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$"


def read_dump(spark: SparkSession, path: str, names: Sequence[str], sep: str = "|", numbers: Sequence[str] = (), ids: Sequence[str] = ()) -> DataFrame:
    """A text dump without header: lines with another number of fields are dropped, empty or bad numbers are null, ids must look like GUIDs and come in upper case."""
    fields = F.split("value", "[|]" if sep == "|" else sep, -1)
    rows = spark.read.text(path).withColumn("_f", fields).filter(F.size("_f") == len(names))
    cells = {n: F.trim(F.get("_f", F.lit(i))) for i, n in enumerate(names)}
    for n in ids:
        rows = rows.filter(cells[n].rlike(GUID))
    return rows.select(*((F.upper(c) if n in ids else c.try_cast("long") if n in numbers else c).alias(n) for n, c in cells.items()))


CERT = "map<string, struct<status: string, t: double, skin: string, charts: map<string, struct<expected: bigint, side: string, verdict: string>>>>"
CERT_ROWS = "array<struct<vid: string, status: string, t: double, skin: string, charts: map<string, struct<expected: bigint, side: string, verdict: string>>>>"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """vid, status, skin, chart, side, expected, verdict from a ledger that is an object by vid or a list of rows; a missing file gives an empty table."""
    try:
        raw = spark.read.options(**BELOW).text(path, wholetext=True)
    except Exception as e:  # only a path that isn't there
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "vid string, status string, skin string, chart string, side string, expected long, verdict string")
    listed = F.ltrim("value").startswith("[")
    body = lambda r, vid: F.struct(vid.alias("vid"), *(r[k].alias(k) for k in ("status", "skin", "charts")))
    by_id = F.transform(F.map_entries(F.from_json("value", CERT)), lambda e: body(e["value"], e["key"]))
    rows = F.transform(F.from_json("value", CERT_ROWS), lambda r: body(r, r["vid"]))
    both = raw.select(F.posexplode_outer(F.when(listed, rows).otherwise(by_id)).alias("_pos", "_r")).filter("_pos IS NOT NULL").select("_r.*")  # one read; outer: else Spark infers a filter that parses all texts once more
    return both.select("vid", "status", "skin", F.explode_outer(F.map_entries("charts")).alias("c")).select("vid", "status", "skin", F.col("c.key").alias("chart"), "c.value.side", "c.value.expected", "c.value.verdict")


def read_series_jsonl(spark: SparkSession, path: str, sidecars: DataFrame | None = None) -> DataFrame:
    """path, t, v, conf from files of [t, value or null, confidence] lines. One bad line makes its whole file missing, as does a sidecar(path, lines, size, sha256) that doesn't fit."""
    rows = spark.read.options(**BELOW).text(path).select(F.input_file_name().alias("path"), F.try_parse_json("value").alias("j"), "value").filter(F.trim("value") != "")
    t, v, c = (F.try_variant_get("j", f"$[{i}]", k) for i, k in ((0, "double"), (1, "long"), (2, "double")))
    rows = rows.select("path", t.alias("t"), v.alias("v"), c.alias("conf"))
    bad = F.max(F.col("t").isNull() | F.col("conf").isNull()).over(Window.partitionBy("path"))  # no join with the bad files: it would open all files twice
    good = rows.withColumn("_bad", bad).filter("NOT _bad").drop("_bad")
    if sidecars is None:
        return good
    raw = spark.read.format("binaryFile").options(**BELOW).load(path).select("path", F.col("length").alias("_size"), F.sha2("content", 256).alias("_sha"))
    lines = rows.groupBy("path").agg(F.count("*").alias("_lines"))
    name = lambda c: F.regexp_replace(c, "^file:/*", "/")
    seen = raw.withColumn("path", name(F.col("path"))).join(lines.withColumn("path", name(F.col("path"))), "path")
    misfit = seen.join(sidecars.withColumn("path", name(F.col("path"))), "path").filter("_size <> size OR _sha <> sha256 OR _lines <> lines").select("path")
    return good.withColumn("path", name(F.col("path"))).join(misfit, "path", "left_anti")


META = "struct<ssc_file: string, DESCRIPTION: string, SONGTYPE: string, `Hold ticks`: array<array<double>>>"


def read_chartstruct(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows: path, time, beat, line), (meta: path, ssc_file, description, songtype, ticks): chart tables, their rows and what their first row says. Lines lose the back-tick before them; hold ticks are rounded to whole numbers."""
    raw = spark.read.options(**BELOW).option("header", "true").option("escape", '"').csv(path).withColumn("path", F.input_file_name())
    rows = raw.select("path", F.col("Time").cast("double").alias("time"), F.col("Beat").cast("double").alias("beat"), F.regexp_replace("Line", "^`", "").alias("line"))
    meta = raw.filter("Metadata IS NOT NULL").select("path", F.from_json("Metadata", META).alias("m"))
    ticks = F.transform("m.Hold ticks", lambda h: F.struct(h[0].alias("t0"), h[1].alias("t1"), F.round(h[2]).cast("long").alias("n")))
    return rows, meta.select("path", F.col("m.ssc_file").alias("ssc_file"), F.col("m.DESCRIPTION").alias("description"), F.col("m.SONGTYPE").alias("songtype"), ticks.alias("ticks"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """archive, name, sha1, is_chart, content: members of zip files; chart tables are the .json files at the top. One archive must fit a task."""
    schema = T.StructType([T.StructField("archive", T.StringType()), T.StructField("name", T.StringType()), T.StructField("sha1", T.StringType()), T.StructField("is_chart", T.BooleanType()), T.StructField("content", T.BinaryType())])

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        if not info.is_dir():
                            body = z.read(info)
                            chart = "/" not in info.filename and info.filename.endswith(".json")
                            yield pd.DataFrame([(archive, info.filename, hashlib.sha1(body).hexdigest(), chart, body)], columns=schema.names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content").mapInPandas(members, schema)


def write_report(df: DataFrame, path: str, order: Sequence[str], kind: str = "json") -> None:
    """df in a fixed order, replacing what is there, whole or not at all (the committer moves finished files only)."""
    df.orderBy(*order).write.mode("overwrite").format(kind).save(path)
