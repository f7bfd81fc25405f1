"""Held-out metrics in one aggregate.

Every metric of an experiment (scored rows, RMSE, misclassified fraction,
biased RMSE) is computed by one global aggregation: partial aggregates per
task, one tiny merge.  Nothing is counted twice and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rmse_expr(label: str | Column, prediction: str | Column) -> Column:
    y = (F.col(label) if isinstance(label, str) else label).cast("double")
    p = (F.col(prediction) if isinstance(prediction, str) else prediction).cast("double")
    return F.sqrt(F.avg(F.pow(y - p, F.lit(2.0))))


def error_fraction_expr(label: str | Column, prediction: str | Column) -> Column:
    """Rows whose rounded prediction differs from the label, over all rows
    (a null comparison counts in the denominator only).  Compared as doubles:
    NaN or a value beyond any class is wrong."""
    y = (F.col(label) if isinstance(label, str) else label).cast("double")
    p = (F.col(prediction) if isinstance(prediction, str) else prediction).cast("double")
    wrong = F.count_if(y != F.round(p))
    return wrong / F.nullif(F.count(F.lit(1)), F.lit(0))


def prediction_metrics(df: DataFrame, label: str, prediction: str = "prediction",
                       classify: bool = True, biased_prediction: str | None = None,
                       by: Sequence[str] = ()) -> DataFrame:
    """One row ``n, n_labelled, rmse, error_fraction, n_bias, rmse_bias``, or
    one for each group of the columns ``by``.

    ``n_labelled`` and ``n_bias`` are the rows that ``rmse`` and ``rmse_bias``
    cover (label and prediction, or biased prediction, present).
    ``error_fraction`` is null unless ``classify``; ``n_bias`` and
    ``rmse_bias`` are null unless a biased prediction column is given.  An
    empty input gives n = 0 and null metrics instead of an error."""
    null = F.lit(None).cast("double")
    y = F.col(label)
    covered = lambda p: F.count_if(y.isNotNull() & F.col(p).isNotNull())
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        covered(prediction).alias("n_labelled"),
        rmse_expr(label, prediction).alias("rmse"),
        (error_fraction_expr(label, prediction) if classify else null).alias("error_fraction"),
        (covered(biased_prediction) if biased_prediction
         else F.lit(None).cast("bigint")).alias("n_bias"),
        (rmse_expr(label, biased_prediction) if biased_prediction else null).alias("rmse_bias"),
    )
