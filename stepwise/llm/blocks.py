"""Documents in blocks of bounded size, and messages between blocks and shards.

A block holds the rows of some document ids, about `block_bytes` of text; a shard
holds the keys of one residue. Blocks send packed arrays of distinct keys to the
shards and get packed answers back, so a key that a third of all rows hold is sent
once by each block, and text moves once: every pass over the blocks reads the same
exchange.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

#: Text of a block on small and on the largest inputs, and keys of a shard.
BLOCK_BYTES, MOST_BLOCK_BYTES = 2 << 20, 16 << 20
SHARD_BYTES = 16 << 20
#: Blocks beyond which they grow instead of becoming more: a key sends one message from each.
BLOCKS = 1 << 16
#: The document of rows without an id: after all others.
NO_ID = 2**63 - 1


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def in_blocks(docs: DataFrame, n_blocks: int, *columns: str) -> DataFrame:
    """block and the columns, dealt by block, which follows from doc_id alone; rows without one are dealt by their text."""
    place = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(NO_ID), "text")).otherwise(F.xxhash64("doc_id"))
    block = F.pmod(place, F.lit(n_blocks)).cast("int").alias("block")
    return docs.select(block, *columns).repartition("block")


def counts(total: int, block_bytes: int, shard_bytes: int) -> tuple[int, int]:
    """How many blocks and shards that many bytes of text make."""
    each = max(block_bytes, min(total // BLOCKS, MOST_BLOCK_BYTES))
    return max(1, math.ceil(total / each)), max(1, math.ceil(total / shard_bytes))


def doc_ids(table: pa.Table) -> np.ndarray:
    """Document ids, NO_ID for null."""
    return table["doc_id"].cast(pa.int64()).fill_null(NO_ID).to_numpy()


def by_shard(keys: np.ndarray, n_shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indexes of its keys in order) for each shard that has any."""
    shard = (keys % np.uint64(n_shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, edges):
        if len(part):
            yield int(shard[part[0]]), part


def unpack(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All items of a binary column, and the number of items in each row."""
    data, offsets = tv.strings(column)
    width = np.dtype(dtype).itemsize
    return np.frombuffer(data.tobytes(), dtype), np.diff(offsets) // width


def text_chunks(table: pa.Table, limit: int = tv.CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of the text column, in bounded pieces."""
    column = table["text"].combine_chunks()
    for a, b in tv.pieces(column, limit):
        yield a, b, *tv.strings(column.slice(a, b - a))


def padded(data: np.ndarray, offsets: np.ndarray, byte: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows with one byte more at the end of each."""
    out = np.full(len(data) + len(offsets) - 1, byte, np.uint8)
    place = np.ones(len(out), bool)
    ends = offsets[1:] + np.arange(len(offsets) - 1)
    place[ends] = False
    out[place] = data
    return out, offsets + np.arange(len(offsets))


def kept_strings(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept bytes of each padded row, without the last one, as a string column."""
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=sums[1:])
    sizes = np.diff(sums[offsets])
    last = sums[offsets[1:]][sizes > 0] - 1
    body = data[keep]
    final = np.ones(len(body), bool)
    final[last] = False
    lengths = np.maximum(sizes - 1, 0)
    bounds = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(body[final].tobytes())]).cast(pa.string())


def answer(left: DataFrame, right: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each block together with the answers addressed to it."""
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(function, schema)
