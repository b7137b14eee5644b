"""Column functions: names, answers, grids, digits, screens and symbols. All stay in the JVM but two."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Eras of upload titles from the oldest, with their mixes; song types by the words of a title and by the end of a key; letters of note cells; kinds of blocks that don't count.
ERAS = {"FIESTA": "Fiesta", "FIESTA 2": "Fiesta 2", "PRIME": "Prime", "PRIME 2": "Prime 2", "XX": "XX", "PHOENIX": "Phoenix", "PHOENIX 2": "Phoenix2"}
SONG_TYPES = {"FULL SONG": "FullSong", "SHORT CUT": "ShortCut"}
KEY_TYPES = ("ARCADE", "SHORTCUT", "REMIX", "FULLSONG")
TO_EMPTY, TO_TAP, TO_HEAD = "FKMVESsv", "IL", "46"
EXCLUDED_KINDS = ("UCS", "COOP", "CO-OP", "HIDDEN", "QUEST", "INFINITY", "TRAIN", "TRAINING", "PRO", "PERFORMANCE", "JUMP")


def norm_title(c: Column, keep: str = "") -> Column:
    """Lower case, only a-z, 0-9 and the characters of the class `keep` (such as Hangul, 가-힣)."""
    return F.regexp_replace(F.lower(c), f"[^a-z0-9{keep}]", "")


def parse_upload_title(c: Column) -> Column:
    """struct(era, name, codes, song_type) of a video's title '[PUMP IT UP <era>] <name> S17 & D20 (...) | ...'; null without the tag or with an era that isn't in ERAS.

    What follows '|' is dropped. The song type is read first, then parentheses go, then codes (S or D,
    perhaps P, one or two digits; given without the P) are looked for. The name is what stands before the
    first code, without the words of the type, normalised (Hangul stays); null where there is no code.
    """
    tag = r"^\s*\[PUMP IT UP ([A-Z0-9 ]+)\]\s*(.*)$"
    code, words = r"\b([SD])P?(\d{1,2})\b", rf"(?i)-?\s*\b({'|'.join(SONG_TYPES)})\b\s*-?"
    era = F.trim(F.regexp_extract(c, tag, 1))
    body = F.substring_index(F.regexp_extract(c, tag, 2), "|", 1)
    said = F.upper(F.regexp_extract(body, words, 1))
    kind = F.lit(None).cast("string")
    for written, value in SONG_TYPES.items():
        kind = F.when(said == written, value).otherwise(kind)
    plain = F.regexp_replace(body, r"\([^)]*\)", " ")
    found = F.zip_with(F.regexp_extract_all(plain, F.lit(code), 1), F.regexp_extract_all(plain, F.lit(code), 2), lambda x, n: F.concat(x, n.cast("int").cast("string")))
    front = F.regexp_extract(plain, rf"^(.*?){code}", 1)
    name = F.when(F.size(found) > 0, norm_title(F.regexp_replace(front, words, " "), "가-힣"))
    return F.when(era.isin(*ERAS), F.struct(era.alias("era"), name.alias("name"), found.alias("codes"), kind.alias("song_type")))


_KEY = rf"_([SD]P?\d+(?:_[A-Z0-9]+)*?)_({'|'.join(KEY_TYPES)})$"


def key_to_tag(c: Column) -> Column:
    """'Song_-_Artist_S17_KIND_ARCADE' to 'S17 KIND_ARCADE': label and song type; null for other keys."""
    label, kind = F.regexp_extract(c, _KEY, 1), F.regexp_extract(c, _KEY, 2)
    return F.when(label != "", F.concat(F.translate(label, "_", " "), F.lit("_"), kind))


def tag_to_key(song: Column, tag: Column) -> Column:
    """The inverse of key_to_tag for a song prefix; null if it doesn't round-trip."""
    label, kind = F.regexp_extract(tag, "^(.*)_([^_]*)$", 1), F.regexp_extract(tag, "^(.*)_([^_]*)$", 2)
    key = F.concat(song, F.lit("_"), F.translate(label, " ", "_"), F.lit("_"), kind)
    return F.when(key_to_tag(key) == tag, key)


def family_of(c: Column, variant: str = "tokens") -> Column:
    """A chart's title family; a chart is its title and, last, its token (S17).

    `tokens`: the last word goes, the rest is folded to ASCII, cut markers between dashes and (PIU
    Edit) go, the first two words stay (the title itself if there are none). `sequel`: token, markers,
    what stands in parentheses or brackets and a sequel number at the end go, normalised. `strip`:
    token and markers between dashes go.
    """
    dashed = r"(?i)\s*-\s*(full song|short cut|remix)\s*-\s*"
    if variant == "tokens":
        title = F.regexp_replace(c, r" [^ ]*$", "")
        plain = F.regexp_replace(F.regexp_replace(F.lower(fold_ascii(title)), dashed, " "), r"\(\s*piu edit\s*\)", " ")
        words = F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), 0)
        return F.when(F.size(words) > 0, F.array_join(F.slice(words, 1, 2), " ")).otherwise(title)
    if variant == "sequel":
        plain = F.regexp_replace(F.lower(F.regexp_replace(c, r" [SD]\d+$", "")), dashed, " ")
        plain = F.regexp_replace(F.regexp_replace(plain, r"\b(short cut|full song|remix)\b", " "), r"\(.*?\)|\[.*?\]", " ")
        plain = norm_title(F.regexp_replace(F.trim(plain), r"\s(\d+|ii|iii|iv|pt\.?\s*\d+|ep\.?\s*\d+)\s*$", " "))
        return F.when(plain != "", plain).otherwise(norm_title(c))
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r" [SD]P?\d+$", ""), dashed, " "), r"\s+", " ")))


def fold_ascii(c: Column) -> Column:
    """Compatibility decomposition without what isn't ASCII."""

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode(), na_action="ignore")

    return fold(c)


def norm_answer(c: Column) -> Column:
    r"""A reader's answer: , ; | \ and line feeds become /, white space goes, repeated / collapse, ends lose theirs, upper case."""
    one = F.translate(c, ",;|\\\n \t\x0b\f\r", "/////")  # white space has no counterpart, so it goes
    return F.upper(F.when(F.contains(one, F.lit("/")), F.regexp_replace(F.regexp_replace(one, "/+", "/"), "^/|/$", "")).otherwise(one))


def is_official(stepstype: Column, songtype: Column, meter: Column, label: Column) -> Column:
    """Standard style and song type, meter other than 99, no word of an excluded kind in the label; a null label passes."""
    style = stepstype.isin("pump-single", "pump-double", "pump-halfdouble")
    kind = F.coalesce(songtype, F.lit("ARCADE")).isin("ARCADE", "FULLSONG", "SHORTCUT", "REMIX")
    clean = ~F.upper(F.coalesce(label, F.lit(""))).rlike(rf"\b({'|'.join(EXCLUDED_KINDS)})\b")
    return style & kind & (F.coalesce(meter, F.lit(0)) != 99) & clean


def exclusions(df: DataFrame, lists: DataFrame, name: str = "name", key: str = "key") -> DataFrame:
    """df with reason: the reason of the list row(item, reason) that its name, else its key, hits (ties: the smallest), else null."""
    one = lists.groupBy("item").agg(F.min("reason").alias("_r"))
    by_name = df.join(one.select(F.col("item").alias(name), F.col("_r").alias("_rn")), name, "left")
    both = by_name.join(one.select(F.col("item").alias(key), F.col("_r").alias("_rk")), key, "left")
    return both.select(*df.columns, F.coalesce("_rn", "_rk").alias("reason"))


def snap_to_grid(beat: Column, grids: Sequence[int], tolerance: float, seconds_per_beat: Column | float = 1.0, finest: int = 48) -> Column:
    """The beat on the coarsest grid (lines per beat) whose nearest line is within `tolerance` seconds, else on the finest."""
    out = F.round(beat * finest) / finest
    for g in sorted(grids, reverse=True):
        line = F.round(beat * g) / g
        out = F.when(F.abs(line - beat) * seconds_per_beat <= tolerance, line).otherwise(out)
    return out


def choose_grid(beat: Column, margin: float = 0.01) -> Column:
    """16 lines a beat, unless the nearest of 12 is closer by more than the margin (in beats): then 12."""
    off = lambda g: F.abs(F.round(beat * g) / g - beat)
    return F.when(off(12) < off(16) - margin, 12).otherwise(16)


def grid_error(beat: Column, grid: Column | int) -> Column:
    """Distance to the nearest line in half steps of the lattice: 0 on a line, 1 midway."""
    x = beat * grid
    return F.abs(x - F.round(x)) * 2


def to_rational(c: Column, most: int = 10_000) -> Column:
    """struct(num, den): the nearest fraction with a denominator up to `most`, by continued fractions over whole batches."""

    @F.pandas_udf("num long, den long")
    def convert(s: pd.Series) -> pd.DataFrame:
        x = s.to_numpy(float, na_value=np.nan)
        ok = np.isfinite(x)
        rest = np.where(ok, x, 0.0)
        whole = np.floor(rest)
        p0, q0, p1, q1 = np.ones_like(x), np.zeros_like(x), whole.copy(), np.ones_like(x)
        rest = rest - whole
        best_p, best_q = p1.copy(), q1.copy()
        live = rest > 1e-12
        for _ in range(40):
            if not live.any():
                break
            inverse = np.where(live, 1 / np.where(live, rest, 1), 0)
            a = np.floor(inverse)
            fits = np.where(q1 > 0, np.floor((most - q0) / np.maximum(q1, 1)), 0)
            full = live & (a <= fits)
            part = live & ~full & (fits > 0)
            sp, sq = fits * p1 + p0, fits * q1 + q0
            closer = part & (np.abs(sp / np.maximum(sq, 1) - x) < np.abs(p1 / q1 - x))
            best_p, best_q = np.where(closer, sp, best_p), np.where(closer, sq, best_q)
            p0, p1 = np.where(full, p1, p0), np.where(full, a * p1 + p0, p1)
            q0, q1 = np.where(full, q1, q0), np.where(full, a * q1 + q0, q1)
            best_p, best_q = np.where(full, p1, best_p), np.where(full, q1, best_q)
            rest = np.where(full, inverse - a, 0)
            live = full & (rest > 1e-9)
        out = pd.DataFrame({"num": best_p, "den": best_q})
        out[~ok] = np.nan
        return out.astype("Int64")

    return convert(c.cast("double"))


def digit_alternatives(v: Column, cap: Column | int) -> Column:
    """All readings of a counter value within 0..cap: each 5 may be a 9, and a hundred may be one too many. Ascending."""
    digits = F.split(v.cast("string"), "")
    swap = F.aggregate(
        F.filter(digits, lambda d: d != ""), F.array(F.lit("")).cast("array<string>"),
        lambda acc, d: F.when(d == "5", F.concat(F.transform(acc, lambda a: F.concat(a, F.lit("5"))), F.transform(acc, lambda a: F.concat(a, F.lit("9"))))).otherwise(F.transform(acc, lambda a: F.concat(a, d))),
    )
    values = F.transform(swap, lambda s: s.cast("long"))
    less = F.filter(F.transform(values, lambda x: x - 100), lambda x: x >= 0)
    return F.array_sort(F.array_distinct(F.filter(F.concat(values, less), lambda x: (x >= 0) & (x <= cap))))


def screen_checks(perfect: Column, great: Column, good: Column, bad: Column, miss: Column, combo: Column) -> Column:
    """Reasons against a result screen: `cells` (one isn't a number), `combo_high` (over perfect + great), `combo_low` (nothing broke it, yet it is lower)."""
    cells = [c.try_cast("long") for c in (perfect, great, good, bad, miss, combo)]
    p, g, _, b, m, x = cells
    unread = F.greatest(*(c.isNull() for c in cells))
    return F.array_compact(F.array(F.when(unread, "cells"), F.when(x > p + g, "combo_high"), F.when((b + m == 0) & (x != p + g), "combo_low")))


def is_clean_play(perfect: Column, great: Column, good: Column, bad: Column, miss: Column, combo: Column, judged: Column) -> Column:
    """The combo ran through: maxcombo = judged and nothing good, bad or missed."""
    return (combo == judged) & (good + bad + miss == 0) & (perfect + great == judged)


def noise_filter(reads: DataFrame, least_conf: float = 0.8, lowest: int = 4, highest: Column | int | None = None) -> DataFrame:
    """Reads with a value of at least `lowest` (the counter is blank below) and at most `highest`, at `least_conf` or more."""
    keep = F.col("v").isNotNull() & (F.col("conf") >= least_conf) & (F.col("v") >= lowest)
    return reads.filter(keep if highest is None else keep & (F.col("v") <= highest))


def judged_symbol(cell: Column) -> Column:
    """The symbol that is judged: 0 empty, 1 tap, 2 head, 3 tail; a cell {t|attr|fake|res} has its t, and 0 if it is fake; letters for co-op stay."""
    inner, fake = F.regexp_extract(cell, r"^\{(.)\|", 1), F.regexp_extract(cell, r"^\{.\|[^|]*\|(\d)", 1)
    sym = F.when(inner == "", cell).otherwise(inner)
    plain = F.translate(sym, TO_EMPTY + TO_TAP + TO_HEAD, "0" * len(TO_EMPTY) + "1" * len(TO_TAP) + "2" * len(TO_HEAD))
    return F.when(fake == "1", "0").otherwise(plain)


def drawn_fake(cell: Column) -> Column:
    """Is a note drawn here that isn't judged: F, or a cell flagged fake of type 1, 2, 3, 4 or 6."""
    return (cell == "F") | cell.rlike(r"^\{[12346]\|[^|]*\|1")


def pick_band(reads: DataFrame, by: str = "vid", band: str = "band", order: Sequence[str] = ("C", "L", "R")) -> DataFrame:
    """The reads of the first band in `order` that has any usable (not null) read, for each video."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(band))
    best = reads.filter(F.col("v").isNotNull() & (place > 0)).groupBy(by).agg(F.min(place).alias("_p"))
    return reads.withColumn("_p", place).join(best, [by, "_p"], "left_semi").drop("_p")


def first_per_key(df: DataFrame, by: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_k = 1").drop("_k")
