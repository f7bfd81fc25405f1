"""Min-max scaling of a column by bounds computed on the cluster.

The bounds are one global aggregate (partial min/max per task, one tiny
merge), referenced through scalar subqueries: Catalyst merges the min and max
subqueries into a single aggregate job and substitutes the two values as
literals.  No driver round trip, no join, no per-row window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairgrade.functions.scale import minmax


def minmax_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row: ``min_<col>``, ``max_<col>`` (nulls ignored; null on empty)."""
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))


def minmax_scale(df: DataFrame, col: str, out: str | None = None,
                 a: float = 1.0, b: float = 5.0,
                 fit_on: DataFrame | None = None) -> DataFrame:
    """Add (or replace) ``out`` = ``col`` scaled from [min, max] to [a, b].

    ``fit_on`` is the frame whose min/max define the range (default: ``df``
    itself, i.e. the whole table before any split).  A constant column yields
    null for every row."""
    src = df if fit_on is None else fit_on
    lo = src.agg(F.min(col)).scalar()
    hi = src.agg(F.max(col)).scalar()
    return df.withColumn(out or col, minmax(F.col(col), lo, hi, a, b))


def minmax_unit(df: DataFrame, col: str, out: str | None = None,
                fit_on: DataFrame | None = None) -> DataFrame:
    """``minmax_scale`` onto [0, 1]."""
    return minmax_scale(df, col, out, 0.0, 1.0, fit_on)
