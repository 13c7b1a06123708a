"""Best-fit packing planned over a histogram of lengths.

Documents become pieces of at most ``CAPACITY`` tokens. Only the histogram of piece lengths (at most
``CAPACITY`` rows) reaches the driver, where best-fit decreasing runs over counts: sequences with the
same free room form runs that are filled together, so the plan's size depends on the number of
lengths, not of documents. A plan row gives the slots for a range of ranks within one length; pieces
take their slots by joining on their rank within their length. Ranks come from counts per (length,
hash bucket) and a numbering within each bucket, so that a length held by most rows is still dealt
over many tasks.

Null and empty texts are one piece (the end token); a very long text is encoded as a whole and cut into pieces;
other columns, whatever their names, are left out; pieces of one length are interchangeable, so
repeated rows and ties only decide which equal slot each takes; an empty table has an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm._common import settled, shuffle_partitions, slices, small_batches
from quirework.llm.bpe import Encoder, MergeTable, load_spec

CAPACITY, END = 4096, 1
#: Plan rows up to which the plan is broadcast; it has a few per length, whatever the input.
PLAN_ROWS = 200_000

Slot = tuple[int, int, int, int, int, int]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, hashed: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and the end token, cut at the capacity.

    With ``hashed`` also text_hash, Spark's xxhash64 of the text: with it a piece finds its text where ids are null or repeated."""
    small_batches(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(MergeTable(spec.value))
        for batch in slices(batches, "text"):
            ids, bounds = coder.encode(batch.column("text").to_pylist())
            rows = []
            for doc, text_hash, (lo, hi) in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), pairwise(bounds.tolist()), strict=True):
                own = np.append(ids[lo:hi], end).astype("<u4")
                for start in range(0, len(own), capacity):
                    part = own[start : start + capacity]
                    rows.append((doc, start // capacity, start, len(part), zlib.crc32(part.tobytes()), text_hash))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(cols)], ["doc_id", "piece", "start", "length", "ids_crc32", "text_hash"])

    key = F.xxhash64("text") if hashed else F.lit(None).cast("long")
    out = docs.select("doc_id", "text", key.alias("text_hash")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, text_hash long")
    return out if hashed else out.drop("text_hash")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """(length, first rank, ranks, pieces in each sequence, first sequence, offset) rows that place every piece.

    Best fit over counts: the longest length first, into the sequences with the least room that is
    still enough; a sequence that fits several of one length takes them one after another."""
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences (first, how many)
    sizes: list[int] = []
    out: list[Slot] = []
    fresh = 0

    def put(free: int, first: int, n: int) -> None:
        if free:
            if free not in room:
                insort(sizes, free)
            room.setdefault(free, []).append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                free = sizes[at]
                first, n = room[free].pop()
                if not room[free]:
                    del room[free], sizes[at]
            else:
                free, first, n = capacity, fresh, -(-left // (capacity // length))
                fresh += n
            each = free // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, full * each, each, first, capacity - free))
                put(free - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            rest = n - full
            if rest and left:  # fewer pieces than one more sequence would take
                out.append((length, rank, left, left, first + full, capacity - free))
                put(free - left * length, first + full, 1)
                full, rest, left = full + 1, rest - 1, 0
            if rest:
                put(free, first + full, rest)
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (rows of :func:`pieces`, read three times: give a settled table) with sequence_id and offset."""
    spark = cut.sparkSession
    histogram = {int(r[0]): int(r[1]) for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots = plan(histogram, capacity)
    table = spark.createDataFrame(slots or [(0, 0, 0, 1, 0, 0)], "p_length long, p_rank long, p_ranks long, p_each long, p_first long, p_offset long")
    buckets = max(32, 2 * shuffle_partitions(spark))
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy("length", "bucket").count().select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("head"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("own", F.row_number().over(within) - 1).join(heads, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("head") + F.col("own"))
    table = F.broadcast(table) if len(slots) <= PLAN_ROWS else table
    at = F.col("rank") - F.col("p_rank")
    placed = ranked.join(table, (F.col("length") == F.col("p_length")) & (at >= 0) & (at < F.col("p_ranks")))
    return placed.select(*cut.columns, (F.col("p_first") + F.floor(at / F.col("p_each"))).cast("long").alias("sequence_id"), (F.col("p_offset") + at % F.col("p_each") * F.col("length")).alias("offset"))


def packed(docs: DataFrame, vocabulary: str, hashed: bool = False) -> DataFrame:
    return pack(settled(pieces(docs, vocabulary, hashed=hashed)))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
