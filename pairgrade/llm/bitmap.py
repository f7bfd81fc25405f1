"""Bitmaps of fixed size that tell which hashes a table may hold.

A bitmap's size is chosen by the caller and does not grow with the table, so it
can be collected and broadcast.  It has false positives, never false negatives:
it only keeps rows that cannot match from being shuffled to an exact join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _words(df: DataFrame, column: str, bits: int) -> DataFrame:
    """(word, set): the bitmap of the top ``bits`` bits of each 64-bit hash in
    ``column``, 64 bits a row, words without any left out."""
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    return (df.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(63).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set")))


def build_bitmap(df: DataFrame, column: str, bits: int = 24) -> np.ndarray:
    """The bitmap on the driver; at most ``2 ** (bits - 6)`` rows reach it."""
    words = _words(df, column, bits).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["word"].to_numpy()] = words["set"].to_numpy()
    return out.view(np.uint64)


def flag_in(df: DataFrame, column: str, other: DataFrame, flag: str, bits: int = 24) -> DataFrame:
    """``df`` with ``flag``: whether the column ``mark`` of ``other`` may hold
    the row's hash, by a broadcast of at most ``2 ** (bits - 6)`` words (4 MB at
    24 bits)."""
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = _words(other, "mark", bits).select(F.col("word").alias("_word"), F.col("set").alias("_set"))
    own = df.withColumn("_word", F.shiftright(slot, 6)).withColumn("_bit", slot.bitwiseAND(63).cast("int"))
    return (own.join(F.broadcast(words), "_word", "left")
            .withColumn(flag, F.coalesce(F.expr("shiftright(_set, _bit) & 1 = 1"), F.lit(False)))
            .drop("_word", "_bit", "_set"))


def drop_rows(docs: DataFrame, bad: DataFrame, mark: str) -> DataFrame:
    """``docs`` (doc_id, and ``mark`` to tell apart rows that share it) without
    the rows of ``bad`` (doc_id, mark); only rows that may go are shuffled."""
    flagged = flag_in(docs, mark, bad, "_touched")
    left = (flagged.where("_touched")
            .join(bad.select("doc_id", F.col("mark").alias(mark)).distinct(), ["doc_id", mark], "left_anti"))
    return flagged.where("not _touched").unionByName(left).drop("_touched", mark)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = 6 + int(len(bitmap)).bit_length() - 1
    slot = hashes >> np.uint64(64 - bits)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
