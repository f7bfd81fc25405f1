"""Encoding of raw item columns into the integers ALS and forests need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

# ---------------------------------------------------------------------------
# Fixed values of the graded-item (diamond) table.  They must stay exactly as
# written: the ordinal code of a level is its 1-based position in the list,
# any other value (and null) is coded 0; decimals become integers by scaling
# with 10**digits and rounding half up.
# ---------------------------------------------------------------------------
CUT_LEVELS = ("Fair", "Good", "Very Good", "Premium", "Ideal")
COLOR_LEVELS = ("J", "I", "H", "G", "F", "E", "D")
CLARITY_LEVELS = ("I1", "SI2", "SI1", "VS2", "VS1", "VVS2", "VVS1", "IF")
FIXED_POINT_DIGITS = {"carat": 2, "depth": 1, "table": 1, "x": 2, "y": 2, "z": 2}
UNKNOWN_LEVEL_CODE = 0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed(c: str | Column, dtype: str | DataType) -> Column:
    """Cast a (string) column; a malformed value becomes null instead of
    failing the job (Spark 4 runs with ANSI casts)."""
    return _col(c).try_cast(dtype)


def fixed_point(c: str | Column, digits: int) -> Column:
    """``round(c * 10**digits)`` as int: 0.57 -> 57 for two digits.

    Rounding is half-up (away from zero).  A value outside the int range
    becomes null rather than wrapping around."""
    scaled = _col(c) if digits == 0 else _col(c) * (10 ** digits)
    return F.round(scaled).try_cast("int")


def ordinal(c: str | Column, levels: Sequence[str],
            default: int = UNKNOWN_LEVEL_CODE) -> Column:
    """Code of an ordered category: position in ``levels`` starting at 1,
    ``default`` for an unlisted level or null.  A CASE chain, not a
    StringIndexer (which would order levels by frequency)."""
    if not levels:
        return F.lit(default)
    src = _col(c)
    expr = F.when(src == levels[0], F.lit(1))
    for code, level in enumerate(levels[1:], start=2):
        expr = expr.when(src == level, F.lit(code))
    return expr.otherwise(F.lit(default))


def round_class(c: str | Column) -> Column:
    """Nearest class of a numeric prediction (half up) as int; NaN or out of
    the int range gives null.  Comparisons with a label use the rounded value
    itself (``operators.metrics``), so such a prediction counts as wrong."""
    return F.round(_col(c)).try_cast("int")


INT_MIN, INT_MAX = -2 ** 31, 2 ** 31 - 1


def as_id(c: str | Column, dtype: DataType | None = None) -> Column:
    """An ALS id: int, whole (fractional values are rounded half up).  Null
    stays null; a value outside the int range fails the job, as a row that
    vanished would not be noticed."""
    src = _col(c)
    whole = src if isinstance(dtype, IntegralType) else F.round(src)
    return (F.when(whole.isNull(), F.lit(None).cast("int"))
             .when(whole.between(INT_MIN, INT_MAX), whole.try_cast("int"))
             .otherwise(F.raise_error(F.concat(F.lit("id outside the int range: "),
                                               src.cast("string"))).cast("int")))
