"""Helpers shared by the corpus operators.

Python code here always works on one Arrow batch at a time, cut into slices of
a bounded number of text bytes, so a task's memory does not depend on how many
rows a partition holds.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            ) -> DataFrame:
    """Only the two columns an operator works on, as ``doc_id`` bigint and
    ``text`` string; any other column, whatever its name, stays out."""
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def text_hash(text: str | Column = "text") -> Column:
    """Tells apart rows that share an id but not a text (null: as empty)."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[at[0]:at[-1]] if len(at) else raw
    return raw, at - at[0]


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps from one task to the next: one object, until
    a task asks for another or (see ``slices``) does not name it."""
    if name not in _KEPT:
        _release()
        _trim()
        _KEPT[name] = make()
    return _KEPT[name]


def _release() -> None:
    if _KEPT:
        _KEPT.clear()
        gc.collect()


def _trim() -> None:
    """Give freed memory back to the system (where the C library can): what a
    task used would count beside what this worker, or another, keeps."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = SLICE_BYTES, keep: str = "") -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice holds about ``max_bytes`` of text (one
    row at least, and a row is never divided).  What earlier tasks left in the
    worker is released, but for the object named ``keep``; what this one freed is
    given back at its end, as a worker may wait beside others for its next task."""
    if keep not in _KEPT:
        _release()
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_buffers(batch.column(batch.schema.get_field_index(text)))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(at, at[lo] + max_bytes, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi
        del batch
    _trim()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


# ---------------------------------------------------------------------------
# Words of a slice, as arrays
# ---------------------------------------------------------------------------
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S32, _S29 = np.uint64(32), np.uint64(29)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _S32)) * _M1
    x ^= x >> _S29
    x *= _M2
    return x ^ (x >> _S32)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold[raw]


def byte_class(inside: str) -> np.ndarray:
    """Which bytes belong to words: ``alnum`` (0-9, a-z, all of UTF-8 beyond
    ASCII), ``visible`` (all but ASCII white space), ``line`` (all but line
    feeds), or else the ASCII characters given."""
    ok = np.ones(256, bool)
    if inside == "alnum":
        ok[:128] = False
        ok[48:58] = ok[97:123] = True
    elif inside == "visible":
        ok[[9, 10, 11, 12, 13, 32]] = False
    elif inside == "line":
        ok[10] = False
    else:
        ok[:] = False
        ok[np.frombuffer(inside.encode("ascii"), np.uint8)] = True
    return ok


class Words:
    """Word spans of several texts: ``start`` and ``end`` in ``raw``, and
    ``first``, where each text's words begin in those arrays (one more entry
    than texts)."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, inside: str):
        ok = byte_class(inside)[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True  # a text's first byte starts a word whatever is before it
        before = np.empty(len(raw), bool)
        if len(raw):
            before[0] = False
            before[1:] = ok[:-1]
        start = np.flatnonzero(ok & (~before | edge[:-1]))
        after = np.empty(len(raw), bool)
        if len(raw):
            after[-1] = False
            after[:-1] = ok[1:]
        end = np.flatnonzero(ok & (~after | edge[1:])) + 1
        self.raw, self.start, self.end = raw, start, end
        self.first = np.searchsorted(start, at)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A 64-bit hash of each word's bytes, eight bytes a step."""
        size = self.end - self.start
        pad = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        view = np.lib.stride_tricks.as_strided(
            pad[:8].view(np.uint64), (max(len(self.raw), 1),), (1,))
        h = mix(size.astype(np.uint64) + np.uint64(seed * int(_M2) % (1 << 64)))
        todo, step = np.arange(len(size)), 0
        while len(todo):
            left = size[todo] - step
            keep = np.minimum(left, 8).astype(np.uint64)
            got = view[self.start[todo] + step]
            got = got & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - keep * np.uint64(8)))
            h[todo] = mix(h[todo] ^ (got * _M1))
            todo, step = todo[left > 8], step + 8
        return h

    def gram_ok(self, k: int) -> np.ndarray:
        """Whether the ``k`` words from each word on lie in one text."""
        n = len(self.start)
        last = np.repeat(self.first[1:], self.counts())
        return np.arange(n) + k <= last

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]].tobytes()


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes; the last ``k - 1`` are of no use
    (see ``Words.gram_ok``)."""
    out = np.zeros(len(words), np.uint64)
    m = len(words) - k + 1
    if m > 0:
        acc = words[:m].copy()
        for j in range(1, k):
            acc *= _M1
            acc += words[j:j + m]
        out[:m] = mix(acc)
    return out
