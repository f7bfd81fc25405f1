"""Reproducible key-hash split.

``randomSplit`` draws per row from a partition-local generator, so the split
changes with the number and order of input partitions (and with a retried
task on a different layout).  Hashing the row key instead gives every row a
fixed number in [0, 1): the same row lands on the same side on any cluster,
and rows sharing a key always land together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def split_unit(keys: Sequence[str | Column], seed: int = 123,
               method: str = "md5") -> Column:
    """A deterministic value in [0, 1) per key.

    ``md5``: first 32 bits of md5("seed|k1|k2|..."), reproducible by any SQL
    engine (use integer or string keys, whose text form is portable).
    ``xxhash64``: cheaper, Spark-only."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    if not cols:
        raise ValueError("split_unit needs at least one key column")
    if method == "md5":
        text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
        head = F.substring(F.md5(text), 1, 8)
        return F.conv(head, 16, 10).cast("bigint") / F.lit(_TWO_32)
    if method == "xxhash64":
        h = F.xxhash64(F.lit(seed), *cols)
        return F.pmod(h, F.lit(4294967296)).cast("double") / F.lit(_TWO_32)
    raise ValueError(f"unknown split hash method {method!r}")
