"""Shared helpers: durable intermediate tables, Arrow text access and vectorised word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quirework.sources import scratch
from quirework.sources.batches import small_batches  # noqa: F401

#: Bytes of text that a Python worker takes at a time (one longer text is still taken whole).
SLICE_BYTES = 2 << 20


# ---------------------------------------------------------------- durable tables
def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, and for checkpoints too (see :mod:`quirework.sources.scratch`)."""
    known = scratch.base(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(known)
    return known


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spooled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a zstd Parquet table in the shared folder and read again.

    Unlike a checkpoint it is compressed and carries no partitioning, so that a later join
    exchanges both sides and AQE can split a skewed one."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spool-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    scratch.until_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- Arrow text
def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = text_buffers(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


# ---------------------------------------------------------------- word hashing
# Multilinear hashing: every byte of a word (word of a gram) times the random weight of its place, added up
# modulo 2**64 and mixed. Unlike powers of one base, no family of texts cancels out whatever the weights are.
_SEED = np.uint64(0x5EED5EED5EED5EED)
_IS_SEP = np.zeros(256, bool)
_IS_SEP[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weights(n: int, kind: int) -> np.ndarray:
    """The weights of the places 0..n, the same however many are asked for."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(np.array([kind], np.uint64) ^ _SEED))


_BYTE = weights(256, 1)
_BYTE[_IS_SEP] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_PLACE = weights(1 << 12, 2)


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words [^\\x20\\x09-\\x0D]+ of each text, and the words before each text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    word = ~_IS_SEP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    edge[0] = edge[-1] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, ~word[:-1]
    starts = np.flatnonzero(word & (before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, ~word[1:]
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A uint64 hash of each word, and the number of words before each text; about ``SLICE_BYTES`` are held in wide arrays at a time."""
    starts, ends, before = word_bounds(data, offs)
    out = np.empty(len(starts), np.uint64)
    values, lo = _BYTE_LOWER if lower else _BYTE, 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SLICE_BYTES, "right")))
        at = starts[lo:hi] - starts[lo]
        part = data[starts[lo] : ends[hi - 1]]
        # the separators after a word weigh nothing
        place = np.arange(len(part)) - np.repeat(at, np.diff(np.r_[at, len(part)]))
        longest = int((ends[lo:hi] - starts[lo:hi]).max())
        table = _PLACE if longest <= len(_PLACE) else weights(longest, 2)
        out[lo:hi] = np.add.reduceat(values[part] * table[np.minimum(place, len(table) - 1)], at)
        lo = hi
    return mix(out), before


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each position of k consecutive words (those across texts too; callers leave them out)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k > 16:  # a long gram by the hashes of the short ones that cover it
        parts, step = gram_hashes(words, 8), [*range(0, k - 8, 8), k - 8]
    else:
        parts, step = words, list(range(k))
    out = np.full(n, k, np.uint64)
    for j, w in zip(step, weights(len(step), 3), strict=True):
        out += parts[j : j + n] * w
    return mix(out)


def short_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of a few words, the same wherever it stands."""
    length = ends - starts
    if not len(length):
        return np.zeros(0, np.uint64)
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    each = words[ragged(starts, length)] * weights(int(length.max()), 3)[place]
    return mix(np.add.reduceat(each, np.cumsum(length) - length) + length.astype(np.uint64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start..start+length of all spans, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    s, n = starts[keep], lengths[keep]
    out[0] = s[0]
    heads = np.cumsum(n)[:-1]
    out[heads] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(out)


def binary_column(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column: row i holds the bytes of flat[bounds[i]:bounds[i + 1]]."""
    flat = np.ascontiguousarray(flat)
    size = flat.dtype.itemsize
    lo = int(bounds[0]) if len(bounds) else 0
    offs = ((bounds - lo) * size).astype(np.int32)
    data = flat[lo : int(bounds[-1])].view(np.uint8) if len(bounds) else flat[:0].view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), max(0, len(bounds) - 1), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(data.tobytes())])


def flat_binary(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column, and the bounds of each row in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    size = np.dtype(dtype).itemsize
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].tobytes() if data is not None else b""
    return np.frombuffer(flat, dtype), (offsets - offsets[0]) // size
