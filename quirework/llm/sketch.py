"""Count-min sketches built by partitions and merged, reduced to "seen at least twice" bitmaps.

A partition sends the cells that its keys hit, not a whole array; tasks that each hold some blocks of
cells add them up, and only the bitmaps of cells with two or more counts come to the driver:
``ROWS`` * width / 8 bytes, 64 MB at the greatest width. A key is estimated repeated if its cell is set
in every row; counts are only ever overestimated, so no repeated key is missed. Past the greatest width
the estimate passes more keys, never fewer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = 2
#: Bounds of log2 of the cells in a row, and of the cells in a block.
NARROW, WIDE, BLOCK = 20, 28, 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def width_for(keys: float) -> int:
    """log2 of a width with eight cells for each expected key, within the bounds."""
    return int(np.clip(np.ceil(np.log2(max(keys, 1) * 8)), NARROW, WIDE))


def _cells(keys: np.ndarray, width: int, row: int) -> np.ndarray:
    return ((keys * _ODD[row]) >> np.uint64(64 - width)).astype(np.int64)


def _gaps(words: np.ndarray) -> bytes:
    """Ascending words as the gaps between them, of two bytes where all fit, after a byte that says how many."""
    gap = np.diff(words, prepend=np.uint32(0))
    size = 2 if int(gap.max()) < 1 << 16 else 4
    return bytes([size]) + gap.astype(f"<u{size}").tobytes()


def _ungaps(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, f"<u{raw[0]}", offset=1), dtype=np.uint32)


def repeated(docs: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], width: int, cut: Callable) -> list[np.ndarray]:
    """The bitmap of each row. ``cut`` slices the batches of a partition; ``keys_of`` gives the keys of a
    slice, one for each time that they count."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [keys_of(b) for b in cut(batches)]
        keys = np.concatenate(held) if held else np.zeros(0, np.uint64)
        for row in range(ROWS):
            at, counts = np.unique(_cells(keys, width, row), return_counts=True)
            blocks = at >> BLOCK
            heads = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(at) else np.zeros(0, np.int64)
            word = ((at & ((1 << BLOCK) - 1)) << 1 | (counts > 1)).astype(np.uint32)
            parts = [_gaps(w) for w in np.split(word, heads[1:])] if len(at) else []
            yield pa.RecordBatch.from_arrays([pa.array(blocks[heads] * ROWS + row, pa.int32()), pa.array(parts, pa.binary())], ["block", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                word = _ungaps(raw)
                count = held.setdefault(block, np.zeros(1 << BLOCK, np.uint8))
                at = word >> 1
                count[at] = np.minimum(count[at] + 1 + (word & 1).astype(np.uint8), 2)
        for block, count in sorted(held.items()):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(count > 1, bitorder="little").tobytes()], pa.binary())], ["block", "cells"])

    sent = docs.mapInArrow(cells, "block int, cells binary")
    rows = sent.repartition("block").mapInArrow(merge, "block int, cells binary").collect()  # ROWS * 2**width / 8 bytes
    maps = [np.zeros(1 << width - 3, np.uint8) for _ in range(ROWS)]
    size = 1 << BLOCK - 3
    for r in rows:
        block, row = divmod(r["block"], ROWS)
        maps[row][block * size : (block + 1) * size] = np.frombuffer(r["cells"], np.uint8)
    return maps


def members(wanted: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Bitmaps in which :func:`passes` finds every key of ``wanted``, and their width."""
    width = width_for(wanted.count())
    # every key counts twice, so that its cell is set
    return repeated(wanted, lambda b: np.repeat(keys_of(b), 2), width, lambda batches: batches), width


def passes(keys: np.ndarray, maps: list[np.ndarray], width: int) -> np.ndarray:
    """Which keys the sketch estimates at two or more."""
    out = np.ones(len(keys), bool)
    for row, bits in enumerate(maps):
        at = _cells(keys, width, row)
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out
