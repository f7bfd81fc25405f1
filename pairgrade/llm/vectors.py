"""Integer vectors of an embedding table, as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairgrade.sources.sinks import materialize

SCALE = 256


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, *more: Column) -> tuple[DataFrame, int]:
    """``(vec_id, x, *more)``, written, and the dimension.

    ``x`` holds floor(256 * component) as bigint (a component beyond its range
    becomes the range's end).  Left out are null and empty vectors, those with a
    null or non-finite component, and those shorter than the longest one left,
    whose length is the dimension (0 for no rows)."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.where(vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))).select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.transform(vector, lambda c: F.floor(c * SCALE).cast("bigint")).alias("x"), *more)
    rows = materialize(rows, "vectors")
    dim = rows.agg(F.max(F.size("x")).alias("n")).first().n or 0
    return rows.where(F.size("x") == dim), dim
