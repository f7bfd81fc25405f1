"""Membership filters: which rows may have an id of a table, before a shuffle.

A Bloom filter of fixed size, built and tested by DataFrame expressions: two
hashes of an id set two of ``2**bits`` bits.  The filter is a table of 64-bit
words, ``2**(bits-6)`` at most (4 MB at 24 bits), so broadcasting it is safe
whatever the number of ids.  It lets some rows pass that have no partner and
never stops one that has: an exact join behind it gives the same rows, with
fewer of them shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24


def _slot(id_col: Column, turn: int, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(id_col, F.lit(turn)), 64 - bits)


def bloom_words(ids: DataFrame, id_col: str, bits: int = BITS) -> DataFrame:
    """(word, bits): the words of the filter that have a bit set."""
    slots = F.array(*[_slot(F.col(id_col), turn, bits) for turn in (1, 2)])
    return (ids.select(F.explode(slots).alias("slot"))
            .select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, int(slot & 63))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")))


def keep_members(df: DataFrame, column: str, ids: DataFrame, id_col: str, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among ``ids``: all that are,
    and of the others few while the ids are far fewer than ``2**bits``."""
    words = bloom_words(ids, id_col, bits)
    kind = ids.schema[id_col].dataType
    for turn in (1, 2):
        own = words.select(F.col("word").alias("__word"), F.col("bits").alias("__bits"))
        df = (df.withColumn("__slot", _slot(F.col(f"`{column}`").cast(kind), turn, bits))
              .withColumn("__word", F.shiftright("__slot", 6)).join(F.broadcast(own), "__word")
              .where(F.expr("shiftright(__bits, int(__slot & 63)) & 1 = 1")).drop("__slot", "__word", "__bits"))
    return df
