"""Range and as-of joins, which Spark has no strategy for.

Both add an equi-key, so that no join falls to a nested loop. A series with very many
rows can be cut into buckets of time: what holds at a bucket's start is carried into
it from the last bucket that has a row, so no task has to hold a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = "_asof"


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, take: Sequence[str], direction: str = "backward", bucket: int | None = None, strict: bool = False) -> DataFrame:
    """left with the columns `take` of the last right row at or before it (forward: the first at or after it); null if there is none.

    Right rows that tie in `on` go by their taken columns: the greatest counts backward,
    the smallest forward. strict leaves out equal instants. `bucket` is a width of
    `on`; rows are then partitioned by (by, bucket).
    """
    back = direction == "backward"
    side_right = 1 if strict else 0
    value = F.struct(*(F.col(c).alias(c) for c in take))
    r = right.select(*by, F.col(on).alias("_at"), value.alias(KEY)).filter("_at IS NOT NULL").withColumn("_side", F.lit(side_right))
    cells = [F.col(c).alias(f"_l{i}") for i, c in enumerate(left.columns)]
    l = left.select(*by, F.col(on).alias("_at"), F.lit(None).cast(r.schema[KEY].dataType).alias(KEY), F.lit(1 - side_right).alias("_side"), F.lit(True).alias("_left"), *cells)  # noqa: E741
    r = r.withColumn("_left", F.lit(False))
    part = list(by)
    if bucket is not None:
        cell = F.floor(F.col("_at") / F.lit(bucket))
        l, r = l.withColumn("_cell", cell), r.withColumn("_cell", cell)  # noqa: E741
        edge = F.max(F.struct("_at", KEY)) if back else F.min(F.struct("_at", KEY))
        marks = r.groupBy(*by, "_cell").agg(edge.alias("_edge")).unionByName(l.select(*by, "_cell").distinct(), allowMissingColumns=True)
        marks = marks.groupBy(*by, "_cell").agg(F.max("_edge").alias("_edge"))
        order = Window.partitionBy(*by).orderBy("_cell" if back else F.desc("_cell")).rowsBetween(Window.unboundedPreceding, -1)
        carry = marks.select(*by, "_cell", F.last("_edge", ignorenulls=True).over(order).alias("_edge")).filter("_edge IS NOT NULL")
        carry = carry.select(*by, F.col("_edge._at").alias("_at"), F.col(f"_edge.{KEY}").alias(KEY), F.lit(side_right).alias("_side"), F.lit(False).alias("_left"), "_cell")
        r = r.unionByName(carry)
        part.append("_cell")
    both = l.unionByName(r, allowMissingColumns=True)
    if back:
        order = Window.partitionBy(*part).orderBy("_at", "_side", KEY).rowsBetween(Window.unboundedPreceding, 0)
    else:
        order = Window.partitionBy(*part).orderBy(F.desc("_at"), F.asc("_side"), F.desc_nulls_last(KEY)).rowsBetween(Window.unboundedPreceding, 0)
    got = both.withColumn("_got", F.last(KEY, ignorenulls=True).over(order)).filter("_left")
    return got.select(*(F.col(f"_l{i}").alias(c) for i, c in enumerate(left.columns)), *(F.col(f"_got.{c}").alias(c) for c in take))


def nearest(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, take: str, tolerance: float | None = None) -> DataFrame:
    """left with `take`, the instant of the nearest right row (the earlier of two equally near), or null beyond the tolerance."""
    r = right.select(*by, F.col(on).alias(on), F.col(on).alias(take))
    got = asof(asof(left, r.withColumnRenamed(take, "_b"), by, on, ["_b"]), r.withColumnRenamed(take, "_f"), by, on, ["_f"], "forward")
    before, after = F.col(on) - F.col("_b"), F.col("_f") - F.col(on)
    pick = F.when(after.isNull() | (before <= after), F.col("_b")).otherwise(F.col("_f"))
    if tolerance is not None:
        pick = F.when(F.least(before, after) <= tolerance, pick)
    return got.withColumn(take, pick).drop("_b", "_f")


def numbered(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """df with the number of each row in this order, from 0: ranges are numbered one by one and moved by the rows before them, so no task sees all rows."""
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    at, starts = 0, []
    for r in ranges.groupBy("_range").count().orderBy("_range").collect():  # one row for each range
        starts.append((r["_range"], at))
        at += r["count"]
    first = df.sparkSession.createDataFrame(starts, "_range int, _first long")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranges.withColumn(name, within).join(first, "_range").withColumn(name, F.col(name) + F.col("_first")).drop("_range", "_first")


def dealt(df: DataFrame, by: Sequence[str], rows: int, most: int = 500_000) -> DataFrame:
    """df of about so many rows dealt by key to as many partitions as shuffles have, or more of about `most` rows: what a task sorts doesn't grow with the table."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // most)), *by)


def bins(start: Column, end: Column, width: float) -> Column:
    """The numbers of the bins of `width` that [start, end] touches."""
    return F.sequence(F.floor(start / width).cast("long"), F.floor(F.greatest(start, end) / width).cast("long"))


def overlap_join(left: DataFrame, right: DataFrame, by: Sequence[str], a: tuple[str, str], b: tuple[str, str], width: float, closed: bool = False) -> DataFrame:
    """Pairs of rows whose intervals a (of left) and b (of right) overlap; closed: touching counts. No other column may be common but `by`.

    Both sides are dealt to bins of `width`; a pair is kept in the first bin that both
    touch. Choose a width near the usual length: a row is copied to every bin it touches.
    """
    l = left.withColumn("_bin", F.explode(bins(F.col(a[0]), F.col(a[1]), width)))  # noqa: E741
    r = right.withColumn("_bin", F.explode(bins(F.col(b[0]), F.col(b[1]), width)))
    pairs = l.join(r, [*by, "_bin"])
    first = F.floor(F.greatest(F.col(a[0]), F.col(b[0])) / width).cast("long")
    meets = (F.col(a[0]) <= F.col(b[1])) & (F.col(b[0]) <= F.col(a[1])) if closed else (F.col(a[0]) < F.col(b[1])) & (F.col(b[0]) < F.col(a[1]))
    return pairs.filter(meets & (F.col("_bin") == first)).drop("_bin")


def count_at(points: DataFrame, queries: DataFrame, by: Sequence[str], point: str, at: str, out: str, bucket: int | None = None) -> DataFrame:
    """queries with the number of points at or before `at` (one sort, no pairs)."""
    order = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    each = points.select(*by, F.col(point).alias(at)).groupBy(*by, at).agg(F.count("*").alias("_each"))
    running = each.withColumn(out, F.sum("_each").over(order)).drop("_each")
    got = asof(queries, running, by, at, [out], bucket=bucket)
    return got.withColumn(out, F.coalesce(out, F.lit(0)).cast("long"))
