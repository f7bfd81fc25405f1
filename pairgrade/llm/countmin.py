"""A count-min sketch of hashes, counted to two, built by partitions.

A hash falls into one cell of each row; its count is at most the least of its
cells.  Cells saturate at two: the sketch only tells what is met once from what
may be met again, and never misses the latter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairgrade.llm.common import mix, slices

DEPTH = 2
#: Cells of a row, as a power of two, within these bounds.  The upper one
#: bounds what is broadcast (a bit a cell: 64 MB a row); beyond its capacity
#: the sketch holds back fewer of the hashes met once.
CELL_BITS = (16, 29)
BLOCK_BITS = 20
FLUSH_HASHES = 6_000_000


def cell_bits(hashes: int, per_hash: int = 4) -> int:
    """Bits for ``per_hash`` cells a hash, within ``CELL_BITS``."""
    return min(max((per_hash * max(hashes, 1) - 1).bit_length(), CELL_BITS[0]), CELL_BITS[1])


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    h = hashes if row == 0 else mix(hashes + np.uint64(row))
    return (h >> np.uint64(64 - bits)).astype(np.uint32)


def pack_gaps(sorted_cells: np.ndarray) -> bytes:
    """Ascending numbers as gaps of one byte (255: add and go on)."""
    gaps = np.diff(sorted_cells.astype(np.int64), prepend=0)
    more = gaps // 255
    out = np.full(int(more.sum()) + len(gaps), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = gaps % 255
    return out.tobytes()


def unpack_gaps(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def pack_cells(sorted_cells: np.ndarray, width: int) -> bytes:
    """Ascending numbers below ``2 ** width`` in the shorter of two forms, told by
    the first byte: gaps (0), or the last byte of each and the other bits as a one
    for each number after a zero for each step (1, and how many numbers).  The
    first takes a byte a number and more where gaps are wide, the second 9 bits
    and a bit for every 256."""
    n, steps = len(sorted_cells), 1 << max(width - 8, 0)
    gaps = np.diff(sorted_cells.astype(np.int64), prepend=0)
    if n + int((gaps // 255).sum()) <= 4 + n + (n + steps + 7) // 8:
        return b"\0" + pack_gaps(sorted_cells)
    ones = np.zeros(n + steps, np.uint8)
    ones[(sorted_cells >> 8).astype(np.int64) + np.arange(n)] = 1
    low = (sorted_cells & 255).astype(np.uint8)
    return b"\1" + n.to_bytes(4, "little") + low.tobytes() + np.packbits(ones, bitorder="little").tobytes()


def unpack_cells(packed: bytes) -> np.ndarray:
    if packed[0] == 0:
        return unpack_gaps(packed[1:])
    n = int.from_bytes(packed[1:5], "little")
    low, ones = np.frombuffer(packed, np.uint8, n, 5), np.frombuffer(packed, np.uint8, offset=5 + n)
    high = np.flatnonzero(np.unpackbits(ones, bitorder="little")) - np.arange(n)
    return high << 8 | low


def partial_sketch(hashes: np.ndarray, depth: int, bits: int) -> Iterator[tuple[int, bytes]]:
    """The cells of some windows, each once or (met more often) twice, by
    block; the blocks of all rows are numbered through."""
    width = min(BLOCK_BITS, bits)
    for row in range(depth):
        own = np.sort(cells(hashes, row, bits))
        again = np.empty(len(own), bool)
        again[:2] = False
        again[2:] = own[2:] == own[:-2]  # a third time and more
        own = own[~again]
        edges = np.searchsorted(own, np.arange((1 << (bits - width)) + 1) << width)
        for b in np.flatnonzero(np.diff(edges)).tolist():
            yield (row << (bits - width)) + b, pack_cells(own[edges[b]:edges[b + 1]] - (b << width), width)


def repeated_cells(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], depth: int, bits: int,
                   ) -> np.ndarray:
    """A bit for each cell that two hashes or more fall into, row by row.

    ``hashes`` gives those of a slice of rows (``df`` has a ``text`` column).
    Each partition sends the cells it met, by block; each block is summed by
    one task, a partition's share at a time.  What comes to the driver is
    ``depth * 2 ** bits`` bits, whatever the table's size."""
    width = min(BLOCK_BITS, bits)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            rows = list(partial_sketch(np.concatenate(held), depth, bits)) if held else []
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.binary())],
                names=["block", "cells"])

        for part in slices(batches, "text"):
            held.append(hashes(part))
            n += len(held[-1])
            if n >= FLUSH_HASHES:
                yield flush()
                held, n = [], 0
        yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts = None, None

        def done():
            packed = np.packbits(counts >= 2, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())],
                                              names=["block", "repeated"])

        for batch in batches:
            for b, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b != block:
                    if block is not None:
                        yield done()
                    block, counts = b, np.zeros(1 << width, np.uint8)
                met = unpack_cells(packed)
                counts[met] += 1
                twice = met[1:][met[1:] == met[:-1]]
                counts[twice] = 2
                np.minimum(counts, 2, out=counts)
        if block is not None:
            yield done()

    merged = (df.mapInArrow(sketch, "block int, cells binary")
              .repartition("block").sortWithinPartitions("block")
              .mapInArrow(merge, "block int, repeated binary").toArrow())
    out = np.zeros((depth << (bits - width), (1 << width) // 8), np.uint8)
    for b, packed in zip(merged["block"].to_pylist(), merged["repeated"]):
        out[b] = np.frombuffer(packed.as_buffer(), np.uint8)
    return out.reshape(depth, -1)


def estimated_repeated(sketch: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for row in range(len(sketch)):
        c = cells(hashes[found], row, bits)
        found[found] = (sketch[row][c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
    return found
