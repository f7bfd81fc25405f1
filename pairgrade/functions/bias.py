"""Piecewise price bias applied to a grade prediction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bias_adjust(prediction: Column, n: Column, pivot: float = 0.5,
                cap: float = 5.0) -> Column:
    """Shift a prediction by a unit-scaled bias ``n``:

    * ``n < pivot``                    -> ``prediction - n``
    * ``n >= pivot`` and sum above cap -> ``cap``
    * otherwise                        -> ``prediction + n``

    Only the upper branch is capped and there is no floor, so the shift jumps
    from ``-pivot`` to ``+pivot`` at ``n == pivot``.  A null ``n`` gives null.
    """
    return (
        F.when(n < F.lit(pivot), prediction - n)
        .when(prediction + n > F.lit(cap), F.lit(float(cap)))
        .otherwise(prediction + n)
    )
