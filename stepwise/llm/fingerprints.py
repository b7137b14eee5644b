"""Document fingerprints: threshold-scaled sketches of shingle sets.

A fingerprint retains every 64-bit shingle hash below 2^64 / `SCALE`. The same
threshold holds for all documents, so fingerprints can be merged by union, and the
containment of a short document in a very long one is estimated without bias from
the hashes that both retain.

The string form is the set's 64-bit digest in hex, a colon, and the retained hashes,
ascending, as base64 of little-endian 64-bit numbers. The digest tells sets apart
that retain nothing; a merged fingerprint has an empty one.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .blocks import text_bytes

SCALE = 4
_BELOW = np.uint64((1 << 64) // SCALE - 1)
#: Bytes of text in one range of doc_id on small and on the largest inputs; ranges beyond which they grow; the fewest ranges for each partition of a shuffle.
RANGE_BYTES, MOST_RANGE_BYTES, RANGES, EACH = 16 << 20, 256 << 20, 1 << 16, 8


def sketch(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[list[np.ndarray], np.ndarray]:
    """(retained hashes of each row, digest of each row's whole shingle set); shingles are k words, as they are."""
    row, value = tv.shingles(tv.Words(data, offsets), k)
    n = len(offsets) - 1
    row, value = tv.unique_pairs(row, value)
    digest = np.zeros(n, np.uint64)
    at = np.flatnonzero(np.diff(row, prepend=-1))
    if len(at):
        digest[row[at]] = np.add.reduceat(tv.mix(value), at)
    low = value <= _BELOW
    return np.split(value[low], np.cumsum(np.bincount(row[low], minlength=n))[:-1]), digest


def encode(hashes: np.ndarray, digest: int | None) -> str:
    return ("" if digest is None else f"{digest:016x}") + ":" + base64.b64encode(hashes.astype("<u8").tobytes()).decode()


def decode(fingerprint: str) -> tuple[np.ndarray, str]:
    digest, _, body = fingerprint.partition(":")
    return np.frombuffer(base64.b64decode(body), "<u8"), digest


def merge(a: str, b: str) -> str:
    """The fingerprint of the union of both shingle sets."""
    return a if a == b else encode(np.union1d(decode(a)[0], decode(b)[0]), None)


def _share(a: np.ndarray, b: np.ndarray, same: bool, of_union: bool) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    whole = len(a) + len(b) - both if of_union else len(a)
    return both / whole if whole else float(same)


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard similarity; where neither retains a hash, 1 for equal sets, else 0."""
    (x, p), (y, q) = decode(a), decode(b)
    return _share(x, y, p == q, True)


def containment(a: str, b: str) -> float:
    """Estimated share of a's shingles that b has; where a retains none, 1 for equal sets, else 0."""
    (x, p), (y, q) = decode(a), decode(b)
    return _share(x, y, p == q, False)


def fingerprint(text: Column, k: int = 5) -> Column:
    """The fingerprint of a text column; null counts as empty."""

    @F.pandas_udf("string")
    def make(texts: pd.Series) -> pd.Series:
        column = pa.array(texts.fillna(""), pa.string())
        out: list[str] = []
        for a, b in tv.pieces(column):
            hashes, digests = sketch(*tv.strings(column.slice(a, b - a)), k)
            out += map(encode, hashes, digests.tolist())
        return pd.Series(out, dtype=object)

    return make(text)


def with_following(docs: DataFrame) -> DataFrame:
    """part, tail, doc_id, text: documents by descending doc_id in ranges; after each range's rows (tail 0) the row that follows them (tail 1).

    After the last document follows the first. Rows that share a doc_id go by a hash of
    the text; rows without one come last, by that hash. Within a partition the rows are
    in order, so each row's follower is the next row of its part. Of a range the driver
    only holds the bounds and the name of its first row.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    total = text_bytes(docs)
    each = max(RANGE_BYTES, min(total // RANGES, MOST_RANGE_BYTES))
    n = max(math.ceil(total / each), EACH * int(spark.conf.get("spark.sql.shuffle.partitions")))
    quantiles = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0]
    bounds = np.unique(np.array(quantiles or [], np.int64))

    @F.pandas_udf("int")
    def under(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(np.int64), "left"), dtype="int32")

    nameless = F.col("doc_id").isNull()
    part = F.when(nameless, len(bounds) + 1 + F.pmod("tie", F.lit(n))).otherwise(under(F.coalesce("doc_id", F.lit(0)))).cast("int").alias("part")
    first = F.min(F.struct((-F.col("doc_id")).alias("down"), "tie", "doc_id"))
    tops = sorted((r.part, r.first.doc_id, r.first.tie) for r in rows.select(part, "doc_id", "tie").groupBy("part").agg(first.alias("first")).collect())  # one row for each range
    follow = [(p, *tops[(i + 1) % len(tops)][1:]) for i, (p, _, _) in enumerate(tops)]
    heads = F.broadcast(spark.createDataFrame(follow, "part int, top long, top_tie long"))  # as many rows as ranges
    named = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("top")) & (F.col("tie") == F.col("top_tie")))
    tails = named.groupBy("part", "doc_id", "tie").agg(F.first("text").alias("text")).select("part", F.lit(1).alias("tail"), "doc_id", "text", "tie")
    both = rows.select(part, F.lit(0).alias("tail"), "doc_id", "text", "tie").union(tails)
    return both.repartition("part").sortWithinPartitions("part", "tail", F.desc_nulls_last("doc_id"), "tie").drop("tie")


NAMES = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
EDITED = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_neighbours(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next.

    A text's edited form has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the document that follows by descending doc_id. Null and
    empty texts have an empty text, whose edited form is empty. A single document
    follows itself. Rows without a doc_id come after all others; rows that share one go
    by a hash of their texts; an empty table gives an empty one; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def finish(rows: list[tuple]) -> pa.RecordBatch:
            """All rows but the last have their follower after them."""
            texts = [r[3] for r in rows]
            prints, digests = sketch(*tv.strings(pa.array(texts, pa.large_string())), k)
            keep = [i for i in range(len(rows) - 1) if not rows[i][1]]
            edited = []
            for i in keep:
                half = len(texts[i]) // 2
                edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
            other, other_digest = sketch(*tv.strings(pa.array(edited, pa.large_string())), k)
            columns = [
                [rows[i][2] for i in keep], [len(texts[i]) for i in keep], edited,
                [encode(prints[i], int(digests[i])) for i in keep], [encode(other[j], int(other_digest[j])) for j in range(len(keep))],
                [_share(prints[i], other[j], digests[i] == other_digest[j], True) for j, i in enumerate(keep)],
                [_share(prints[i], prints[i + 1], digests[i] == digests[i + 1], True) for i in keep],
            ]
            types = (pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)

        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[3])
                if size > tv.CHUNK_BYTES and len(held) > 1:
                    yield finish(held)
                    held, size = held[-1:], len(row[3])
        if len(held) > 1:
            yield finish(held)

    return with_following(docs).mapInArrow(run, EDITED)
