"""The driver's tables as the series, spans, schedules and ledgers that operators take.

Each adapter is a plain projection, so column pruning and filters reach the scan; SQL
has the same projection as a DuckDB common table expression. Times are whole
microseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._range import dealt
from ..session import prepare

MINUTE, HOUR = 60_000_000, 3_600_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """These columns of lineitem with l_orderkey, dealt by order in proportion to its rows, which the file's footers give."""
    rows = table(spark, sf_dir, "lineitem")
    return dealt(rows.select("l_orderkey", *columns), ["l_orderkey"], rows.count())


def events(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """series, id, t, v (whole), k (0 to 99), conf, kind."""
    rows = table(spark, sf_dir, "events")
    if kind:
        rows = rows.filter(F.col("event_type") == kind)
    k = F.get_json_object("props", "$.k").cast("long")
    return rows.select(F.col("user_id").alias("series"), F.col("event_id").alias("id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.floor("value").cast("long").alias("v"), k.alias("k"), (k / 100).alias("conf"), F.col("event_type").alias("kind"))


def spans(spark: SparkSession, sf_dir: str, kind: str = "view", minutes: int = 20) -> DataFrame:
    """series, id, s, e: a span of k times `minutes` from each event of a kind with k > 0."""
    rows = events(spark, sf_dir, kind).filter("k > 0")
    return rows.select("series", "id", F.col("t").alias("s"), (F.col("t") + F.col("k") * (minutes * MINUTE)).alias("e"))


EVENTS = "events_ AS (SELECT user_id AS series, event_id AS id, epoch_us(ts) AS t, CAST(floor(value) AS BIGINT) AS v, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) / 100 AS conf, event_type AS kind FROM events)"


def SPANS(name: str, kind: str, minutes: int) -> str:  # noqa: N802
    return f"{name} AS (SELECT series, id, t AS s, t + k * {minutes * MINUTE} AS e FROM events_ WHERE kind = '{kind}' AND k > 0)"
