"""Column expressions.  All are built-in Spark SQL functions, so they stay
inside whole-stage codegen; nothing here is a Python UDF."""

from pairgrade.functions.bias import bias_adjust
from pairgrade.functions.encode import (
    as_id, fixed_point, ordinal, round_class, typed,
)
from pairgrade.functions.scale import minmax
from pairgrade.functions.split import split_unit

__all__ = [
    "as_id", "bias_adjust", "fixed_point", "minmax", "ordinal",
    "round_class", "split_unit", "typed",
]
