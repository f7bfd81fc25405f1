"""Min-max scaling as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minmax(c: Column, lo: Column | float, hi: Column | float,
           a: float = 0.0, b: float = 1.0) -> Column:
    """``((c - lo) / (hi - lo)) * (b - a) + a``.

    ``lo``/``hi`` may be literals or scalar-subquery columns.  A constant
    column (``hi == lo``) gives null instead of a division-by-zero error."""
    lo_c = F.lit(lo) if not isinstance(lo, Column) else lo
    hi_c = F.lit(hi) if not isinstance(hi, Column) else hi
    lo_d = lo_c.cast("double")
    span = F.nullif(hi_c.cast("double") - lo_d, F.lit(0.0))
    unit = (c.cast("double") - lo_d) / span
    if (a, b) == (0.0, 1.0):
        return unit
    return unit * F.lit(float(b - a)) + F.lit(float(a))
