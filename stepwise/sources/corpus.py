"""Step-file corpora as tables: files, blocks, tags, schedules and notes.

read_corpus -> split_blocks -> parse_tags -> parse_schedule / explode_notes -> render_grid.
Beats are exact fractions (struct of num and den, reduced); join on those, never on the
double that stands beside them for sorting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import drawn_fake, judged_symbol


def read_corpus(spark: SparkSession, path: str, rev: str = "head", names: str = "*.ssc") -> DataFrame:
    """rev, path, pack, song, content for every step file (by its name) under path; UTF-8 (bad bytes replaced), line ends as line feeds. Pack and song are the two folders over the file."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(path)
    parts = F.split("path", "/")
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\r\n?", "\n")
    return raw.select(F.lit(rev).alias("rev"), "path", F.element_at(parts, -3).alias("pack"), F.element_at(parts, -2).alias("song"), text.alias("content"))


def split_blocks(files: DataFrame) -> DataFrame:
    """rev, path, pack, song, block (from 0), header, text, block_sha, header_sha: a block starts at a #NOTEDATA: that starts a line; both texts lose white space at their end."""
    pieces = F.split("content", r"(?m)^(?=#NOTEDATA:)")
    whole = files.select("rev", "path", "pack", "song", F.rtrim(F.regexp_replace(F.get(pieces, F.lit(0)), r"\s+$", "")).alias("header"), F.slice(pieces, F.lit(2), F.size(pieces)).alias("_pieces"))  # a step before the explode: above it, each block would split its whole file again
    rows = whole.select("rev", "path", "pack", "song", "header", F.posexplode_outer("_pieces").alias("block", "text")).filter("block IS NOT NULL")  # outer: else Spark infers a filter that splits all texts once more
    rows = rows.withColumn("text", F.regexp_replace("text", r"\s+$", ""))
    return rows.withColumn("block_sha", F.sha2("text", 256)).withColumn("header_sha", F.sha2("header", 256))


def reachable(blocks: DataFrame, tag: str = "tag") -> DataFrame:
    """blocks(rev, path, block, tag) with reachable: the first block of a file with a tag is, later ones aren't."""
    order = Window.partitionBy("rev", "path", tag).orderBy("block")
    return blocks.withColumn("reachable", F.row_number().over(order) == 1)


def tag_map(text: Column) -> Column:
    """The #KEY:VALUE; pairs of a text as a map; a value may hold colons; of a repeated key the first counts."""
    pairs = F.regexp_extract_all(text, F.lit(r"(?s)#([A-Z0-9_]+:[^;]*);"), 1)
    entries = F.transform(pairs, lambda p: F.struct(F.substring_index(p, ":", 1).alias("key"), F.trim(F.regexp_replace(p, r"(?s)^[A-Z0-9_]+:", "")).alias("value")))
    return F.map_from_entries(F.reverse(entries))  # the last of a key wins under LAST_WIN, so the first comes last


def parse_tags(blocks: DataFrame) -> DataFrame:
    """blocks with tags: the block's own over the header's."""
    return blocks.withColumn("tags", F.map_concat(tag_map(F.col("header")), tag_map(F.col("text"))))


def parse_schedules(blocks: DataFrame, tags: Sequence[str], key: list[str]) -> DataFrame:
    """key, tag, beat, value, more: the entries 'beat=value[=...]' of these tags, read in one pass; blanks and bad numbers are skipped, the later of two entries on a beat wins."""
    each = F.array(*(F.struct(F.lit(t).alias("tag"), F.split(F.element_at("tags", t), ",").alias("entries")) for t in tags))
    rows = blocks.select(*key, F.explode_outer(each).alias("_t"))  # outer: without a filter that reads all tags once more
    rows = rows.select(*key, "_t.tag", F.posexplode_outer("_t.entries").alias("pos", "entry"))
    part = lambda i: F.trim(F.get(F.split("entry", "="), F.lit(i)))
    rows = rows.select(*key, "tag", "pos", part(0).try_cast("double").alias("beat"), part(1).try_cast("double").alias("value"), F.slice(F.split("entry", "="), F.lit(3), F.size(F.split("entry", "="))).alias("more")).filter("beat IS NOT NULL AND value IS NOT NULL")
    return rows.groupBy(*key, "tag", "beat").agg(F.max_by(F.struct("value", "more"), "pos").alias("_s")).select(*key, "tag", "beat", "_s.value", "_s.more")


def parse_schedule(blocks: DataFrame, tag: str, key: list[str]) -> DataFrame:
    """key, beat, value, more: what parse_schedules gives for one tag."""
    return parse_schedules(blocks, [tag], key).drop("tag")


def _gcd(a: Column, b: Column, finish: Callable[[Column], Column] = lambda g: g) -> Column:
    """finish(greatest common divisor), worked out once; Euclid from a % b on takes fewer steps than 1.45 * log2(b) + 2."""
    step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % F.when(s["b"] == 0, 1).otherwise(s["b"])).alias("b")))
    steps = F.sequence(F.lit(1), F.ceil(1.45 * F.log2(F.greatest(b, F.lit(1)).cast("double"))).cast("int") + 3)
    return F.aggregate(steps, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step, lambda s: finish(s["a"]))


def _reduced(num: Column, den: Column, n: str = "num", d: str = "den") -> Column:
    """num / den as a struct in lowest terms; 0 has den 1."""
    over = lambda g: F.struct((num / g).cast("long").alias(n), (den / g).cast("long").alias(d))
    return F.when(num == 0, F.struct(F.lit(0).cast("long").alias(n), F.lit(1).cast("long").alias(d))).otherwise(_gcd(F.greatest(num, F.lit(1)), den, over))


def beat_of(measure: Column, row: Column, rows: Column) -> Column:
    """4 * measure + 4 * row / rows as a reduced fraction."""
    return _reduced((measure * rows + row).cast("long") * 4, rows.cast("long"))


def note_rows(blocks: DataFrame, key: list[str]) -> DataFrame:
    """key, measure, row, rows, line, beat, at: the rows of #NOTES that hold anything; comments are cut; a half-double row of six panels becomes ten, two empty at each side."""
    notes = F.regexp_replace(F.element_at("tags", "NOTES"), r"//[^\n]*", "")
    measures = blocks.select(*key, F.posexplode_outer(F.split(notes, ",")).alias("measure", "body")).filter("measure IS NOT NULL")
    lines = F.filter(F.transform(F.split("body", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    rows = measures.withColumn("_l", lines).withColumn("rows", F.size("_l")).select(*key, "measure", "rows", F.posexplode("_l").alias("row", "line")).filter(F.col("line").rlike("[^0]"))  # most rows are empty: they aren't cut into cells
    cells = F.regexp_extract_all("line", F.lit(r"\{[^}]*\}|."), 0)
    rows = rows.withColumn("cells", cells)
    rows = rows.withColumn("cells", F.when(F.size("cells") == 6, F.concat(F.array(F.lit("0"), F.lit("0")), "cells", F.array(F.lit("0"), F.lit("0")))).otherwise(F.col("cells")))
    rows = rows.filter(F.exists("cells", lambda c: c != "0")).withColumn("beat", beat_of(F.col("measure"), F.col("row"), F.col("rows")))
    return rows.select(*key, "measure", "row", "rows", "cells", "beat", (F.col("beat.num") / F.col("beat.den")).alias("at"))


def explode_notes(blocks: DataFrame, key: list[str]) -> DataFrame:
    """key, beat, at, col, sym: one row for each panel that is judged (sym not 0)."""
    rows = note_rows(blocks, key).select(*key, "beat", "at", F.posexplode("cells").alias("col", "cell"))
    return rows.withColumn("sym", judged_symbol(F.col("cell"))).filter("sym <> '0'").drop("cell")


def fake_notes(blocks: DataFrame, key: list[str]) -> DataFrame:
    """key, beat, at, col: drawn notes that aren't judged."""
    rows = note_rows(blocks, key).select(*key, "beat", "at", F.posexplode("cells").alias("col", "cell"))
    return rows.filter(drawn_fake(F.col("cell"))).drop("cell")


def judged_rows(notes: DataFrame, key: list[str]) -> DataFrame:
    """key, taps: judged tap rows; a jump is one."""
    return notes.filter("sym = '1'").groupBy(*key).agg(F.countDistinct("beat").alias("taps"))


def give_way(notes: DataFrame, key: list[str], grid: int) -> DataFrame:
    """notes(key, beat, col, sym) in which no hold ends where the next note of its column begins.

    Such a tail is released 1/grid of a beat earlier; if that isn't after the head, the hold is too
    short to write, and its head becomes a tap. So does a head without a tail; a tail without a head goes.
    """
    column = Window.partitionBy(*key, "col").orderBy("_at", "_kind")
    rows = notes.withColumn("_at", F.col("beat.num") / F.col("beat.den")).withColumn("_kind", F.when(F.col("sym") == "3", 0).otherwise(1))
    closes = (F.col("sym") == "2") & (F.lead("sym").over(column) == "3")
    rows = rows.withColumn("_end", F.when(closes, F.lead("beat").over(column))).filter("sym <> '3'")
    place = Window.partitionBy(*key, "col").orderBy("_at")
    rows = rows.withColumn("_next", F.lead("_at").over(place))
    end = F.col("_end.num") / F.col("_end.den")
    meets = F.coalesce(end == F.col("_next"), F.lit(False))
    num, den = F.col("_end.num") * grid - F.col("_end.den"), F.col("_end.den") * grid
    earlier = _gcd(F.greatest(num, F.lit(1)), den, lambda g: F.struct((num / g).cast("long").alias("num"), (den / g).cast("long").alias("den")))
    fits = num / den > F.col("_at")
    rows = rows.withColumn("_end", F.when(meets & fits, earlier).when(~meets & (end > F.col("_at")), F.col("_end"))).withColumn("sym", F.when((F.col("sym") == "2") & F.col("_end").isNull(), "1").otherwise(F.col("sym")))
    both = F.array(F.struct("beat", "sym"), F.when(F.col("_end").isNotNull(), F.struct(F.col("_end").alias("beat"), F.lit("3").alias("sym"))))
    return rows.select(*key, "col", F.explode_outer(F.array_compact(both)).alias("_b")).select(*key, "_b.beat", "col", "_b.sym")  # no union: it would lose the partitioning


def render_grid(notes: DataFrame, key: list[str], width: int, finest: int = 192, grid: int = 48) -> DataFrame:
    """key, measure, rows, text: measures on the smallest subdivision that holds every beat.

    notes(key, beat struct, col, sym). A tail on the head of the next note gives way by a step of
    1/grid beat, or its hold becomes a tap (see give_way). Two other symbols on one panel and beat
    are an error, given as a null text.
    """
    rows = give_way(notes, key, grid).withColumn("measure", F.floor(F.col("beat.num") / (4 * F.col("beat.den"))))
    inside = _reduced(F.col("beat.num") - 4 * F.col("measure") * F.col("beat.den"), 4 * F.col("beat.den"), "n", "d")
    measures = rows.withColumn("_i", inside).groupBy(*key, "measure").agg(F.collect_set(F.struct("_i.n", "_i.d", "col", "sym")).alias("_c"))
    lcm = lambda acc, d: (acc * d / _gcd(acc, d)).cast("long")
    measures = measures.withColumn("rows", F.aggregate(F.array_distinct(F.transform("_c", lambda c: c["d"])), F.lit(4).cast("long"), lcm))
    place = F.transform("_c", lambda c: F.struct((c["n"] * (F.col("rows") / c["d"]).cast("long") * width + c["col"]).alias("k"), c["sym"].alias("v")))
    measures = measures.withColumn("_c", F.sort_array(place))
    at = lambda k: (k + F.floor(k / width)).cast("int")  # where a cell stands, line feeds counted
    line = F.lit("0" * width + "\n")
    zeros = lambda a, b: F.substr(F.repeat(line, F.floor((b - a) / (width + 1)).cast("int") + 2), a % (width + 1) + 1, b - a)
    cell = lambda c, i: F.concat(zeros(F.when(i == 0, 0).otherwise(at(F.get("_c", i - 1)["k"]) + 1), at(c["k"])), c["v"])
    last = zeros(at(F.get("_c", F.size("_c") - 1)["k"]) + 1, (F.col("rows") * (width + 1) - 1).cast("int"))
    text = F.concat(F.array_join(F.transform("_c", cell), ""), last)
    good = (F.size(F.array_distinct(F.transform("_c", lambda c: c["k"]))) == F.size("_c")) & ~F.exists("_c", lambda c: c["v"].isNull())
    return measures.select(*key, "measure", "rows", F.when(good & (F.col("rows") <= finest), text).alias("text"))
