"""Train/test split by key hash (see ``pairgrade.functions.split``).

Both sides are plain filters over the same lineage: no shuffle, no sort, no
sampling state.  Callers that read both sides more than once should
materialise the source first (``pairgrade.sources.sinks.materialize``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairgrade.functions.split import split_unit


def with_split(df: DataFrame, keys: Sequence[str | Column], fraction: float = 0.7,
               seed: int = 123, out: str = "is_train",
               method: str = "md5") -> DataFrame:
    """Add a boolean column: true for the training side."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return df.withColumn(out, split_unit(keys, seed, method) < F.lit(float(fraction)))


def hash_split(df: DataFrame, keys: Sequence[str | Column], fraction: float = 0.7,
               seed: int = 123, method: str = "md5") -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, complete, about ``fraction`` of the keys in
    train, independent of partitioning and row order."""
    u = split_unit(keys, seed, method)
    f = F.lit(float(fraction))
    return df.where(u < f), df.where(u >= f)
