"""User-level experiments.

Pair experiment: two columns of the item table act as ALS user and item, a
third as the rating; fit on the training side of a key-hash split, score the
other side (cold rows dropped), report the number of scored rows, RMSE, the
misclassified fraction of rounded predictions and, with a bias column, the
RMSE of bias-adjusted predictions.  Variants: the rating may first be
min-max scaled over the whole table.

Forest experiment: a random-forest classifier or regressor on all or some of
the feature columns (or a ready vector column, e.g. read from LibSVM),
reporting the misclassified fraction or the RMSE on the held-out side.

Each experiment returns a one-row DataFrame; all its metrics come from one
aggregation over the scored rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairgrade.functions.bias import bias_adjust
from pairgrade.functions.encode import as_id
from pairgrade.functions.scale import minmax
from pairgrade.functions.split import split_unit
from pairgrade.operators.factor import (
    SEED, NoRatings, check_als_params, fit_als, no_ratings, score_als, unusable,
)
from pairgrade.operators.forest import assemble, fit_forest, score_forest, slice_features
from pairgrade.operators.metrics import prediction_metrics
from pairgrade.operators.scale import minmax_scale, minmax_unit
from pairgrade.sources.sinks import Scratch, materialize, written_bounds

TRAIN_FRACTION = 0.7
SCALE_RANGE = (1.0, 5.0)
BIAS_PIVOT = 0.5
BIAS_CAP = 5.0

SPLIT_COL = "is_train"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def scale_label(frame: DataFrame, scale_rating: tuple[float, float] | None,
                label: str = "label") -> DataFrame:
    """Min-max scale the label over the whole frame (both sides of the split,
    as the bounds are taken before splitting)."""
    if scale_rating is None:
        return frame
    a, b = scale_rating
    return minmax_scale(frame, label, label, a, b)


def scale_written(frame: DataFrame, scale_rating: tuple[float, float] | None,
                  label: str = "label") -> DataFrame:
    """The same for a written frame that many jobs read: its bounds are taken
    once, from the footers of its files, and become literals."""
    if scale_rating is None:
        return frame
    low, high = written_bounds(frame, label)
    a, b = scale_rating
    lit = lambda v: F.lit(v).cast("double")
    return frame.withColumn(label, minmax(F.col(label), lit(low), lit(high), a, b))


def usable_counts(frame: DataFrame, user: str = "user_id", item: str = "item_id",
                  label: str = "label") -> tuple[int, int, int]:
    """(usable training rows, dropped training rows, dropped test rows), in one
    aggregate: a training row needs both ids and a rating, a test row both
    ids."""
    train = F.col(SPLIT_COL)
    bad, lost = unusable(user, item, label), unusable(user, item)
    row = frame.agg(F.count_if(train & ~bad), F.count_if(train & bad), F.count_if(~train & lost)).first()
    return tuple(row)


def pair_frame(df: DataFrame, user: str, item: str, rating: str,
               key: str | Sequence[str], *, bias: str | None = None,
               scale_rating: tuple[float, float] | None = None, seed: int = SEED,
               train_fraction: float = TRAIN_FRACTION,
               split_method: str = "md5") -> DataFrame:
    """key columns, user_id, item_id (ALS ints), label, [bias_value], is_train."""
    keys = _keys(key)
    schema = df.schema
    cols: list[Column] = [F.col(k) for k in keys]
    label = F.col(rating).cast("double") if scale_rating is not None else F.col(rating)
    cols += [as_id(user, schema[user].dataType).alias("user_id"),
             as_id(item, schema[item].dataType).alias("item_id"),
             label.alias("label")]
    if bias is not None:
        cols.append(F.col(bias).cast("double").alias("bias_value"))
    split = split_unit(keys, seed, split_method) < F.lit(float(train_fraction))
    return scale_label(df.select(*cols, split.alias(SPLIT_COL)), scale_rating)


def add_bias(scored: DataFrame, pivot: float = BIAS_PIVOT, cap: float = BIAS_CAP) -> DataFrame:
    """``bias_n``: bias value unit-scaled over the scored rows themselves;
    ``prediction_bias``: the piecewise-adjusted prediction."""
    scored = minmax_unit(scored, "bias_value", "bias_n")
    return scored.withColumn("prediction_bias",
                             bias_adjust(F.col("prediction"), F.col("bias_n"), pivot, cap))


def pair_predictions(df: DataFrame, user: str, item: str, rating: str,
                     key: str | Sequence[str], *, bias: str | None = None,
                     bias_pivot: float = BIAS_PIVOT, bias_cap: float = BIAS_CAP,
                     scale_rating: tuple[float, float] | None = None,
                     seed: int = SEED, train_fraction: float = TRAIN_FRACTION,
                     split_method: str = "md5", materialized: bool = True,
                     add_bias_columns: bool = True, **als_params):
    """Fit ALS on the training side and score the test side.

    Returns ``(model, scored, dropped)``; ``scored`` has the key columns,
    user_id, item_id, label, prediction and, with a bias column, bias_value,
    bias_n and prediction_bias; ``dropped`` counts the training and the test
    rows that cannot be used (null id; in training also a null or NaN rating).

    ``materialized``: the narrow encoded frame is written once to the shared
    checkpoint folder, so the source (scan, joins, encoding) is computed once
    for both sides instead of once per side, and a lost executor re-reads
    files instead of recomputing the source."""
    check_als_params(**als_params)
    frame = pair_frame(df, user, item, rating, key, bias=bias, seed=seed,
                       train_fraction=train_fraction, split_method=split_method)
    if scale_rating is not None:
        frame = frame.withColumn("label", F.col("label").cast("double"))
    if materialized:
        frame = materialize(frame, "pair")
    frame = scale_written(frame, scale_rating)
    usable, *dropped = usable_counts(frame)
    if not usable:
        raise NoRatings(no_ratings(user, item, rating))
    train = frame.where(F.col(SPLIT_COL))
    test = frame.where(~F.col(SPLIT_COL)).drop(SPLIT_COL)
    model = fit_als(train, "user_id", "item_id", "label", seed=seed, checked=True, **als_params)
    scored = score_als(model, test)
    if bias is not None and add_bias_columns:
        scored = add_bias(scored, bias_pivot, bias_cap)
    return model, scored, tuple(dropped)


def pair_metrics(scored: DataFrame, user: str, item: str, classify: bool = True,
                 dropped: tuple[int, int] | None = None) -> DataFrame:
    """One row: user, item, n, n_labelled, rmse, error_fraction, n_bias,
    rmse_bias, dropped_train, dropped_test."""
    biased = "prediction_bias" if "prediction_bias" in scored.columns else None
    m = prediction_metrics(scored, "label", "prediction", classify=classify,
                           biased_prediction=biased)
    train, test = dropped or (None, None)
    return m.select(F.lit(user).alias("user"), F.lit(item).alias("item"), "*",
                    F.lit(train).cast("bigint").alias("dropped_train"),
                    F.lit(test).cast("bigint").alias("dropped_test"))


def pair_experiment(df: DataFrame, user: str, item: str, rating: str,
                    key: str | Sequence[str], *, classify: bool | None = None,
                    **params) -> DataFrame:
    """One row as of ``pair_metrics``.

    ``classify`` defaults to true for an unscaled rating (a grade) and false
    for a scaled one; ``bias=<column>`` adds the biased RMSE."""
    if classify is None:
        classify = params.get("scale_rating") is None
    bias = params.pop("bias", None)
    pivot = params.pop("bias_pivot", BIAS_PIVOT)
    cap = params.pop("bias_cap", BIAS_CAP)
    _, scored, dropped = pair_predictions(df, user, item, rating, key, bias=bias, bias_pivot=pivot,
                                          bias_cap=cap, add_bias_columns=False, **params)
    if bias is not None:
        scored = biased_scores(scored, pivot, cap, params.get("materialized", True))
    return pair_metrics(scored, user, item, classify, dropped)


def biased_scores(scored: DataFrame, pivot: float = BIAS_PIVOT, cap: float = BIAS_CAP,
                  materialized: bool = True, scratch: Scratch | None = None) -> DataFrame:
    """The biased prediction needs min/max over the scored rows, i.e. a second
    pass over them.  Scoring (two factor joins) runs once: its narrow output
    (label, prediction, bias value) is written to the shared checkpoint
    folder (into ``scratch``, if its owner has no further use for it), then both
    the bounds and the metrics read that table."""
    narrow = scored.select("label", "prediction", "bias_value")
    if materialized:
        narrow = (scratch.write if scratch else materialize)(narrow, "scored")
    return add_bias(narrow, pivot, cap)


# --------------------------------------------------------------------------
# forests
# --------------------------------------------------------------------------

def content_key(label: str, features: str) -> Column:
    """Split key for rows without an id (LibSVM input): the row's content,
    so equal rows share a side."""
    return F.concat_ws(",", F.col(label).cast("string"),
                       F.array_join(vector_to_array(F.col(features)).cast("array<string>"), ","))


def forest_frame(df: DataFrame, label: str, features: str | Sequence[str],
                 key: str | Sequence[str] | None = None, *,
                 subset: Sequence[int] | None = None, seed: int = SEED,
                 train_fraction: float = TRAIN_FRACTION,
                 split_method: str = "md5") -> DataFrame:
    """key columns, label (double), features (vector), is_train."""
    if isinstance(features, str):
        vec = df
        fcol = features
    else:
        vec = assemble(df, features, out="__features")
        fcol = "__features"
    if subset is not None:
        vec = slice_features(vec, subset, fcol, "__subset")
        fcol = "__subset"
    keys: list[Column | str] = _keys(key) if key is not None else [content_key(label, fcol)]
    split = split_unit(keys, seed, split_method) < F.lit(float(train_fraction))
    key_cols = [k for k in keys if isinstance(k, str)]
    return vec.select(*key_cols, F.col(label).cast("double").alias("label"),
                      F.col(fcol).alias("features"), split.alias(SPLIT_COL))


def forest_predictions(df: DataFrame, label: str, features: str | Sequence[str],
                       key: str | Sequence[str] | None = None, *, kind: str = "class",
                       num_classes: int | None = None, subset: Sequence[int] | None = None,
                       seed: int = SEED, train_fraction: float = TRAIN_FRACTION,
                       split_method: str = "md5", materialized: bool = True,
                       **forest_params):
    """Fit a forest on the training side, score the test side.
    Returns ``(model, scored)`` with key columns, label, features, prediction.
    ``materialized`` as in ``pair_predictions``."""
    frame = forest_frame(df, label, features, key, subset=subset, seed=seed,
                         train_fraction=train_fraction, split_method=split_method)
    if materialized:
        frame = materialize(frame, "forest-frame")
    train = frame.where(F.col(SPLIT_COL))
    test = frame.where(~F.col(SPLIT_COL)).drop(SPLIT_COL)
    model = fit_forest(train, kind, "label", "features", num_classes=num_classes,
                       seed=seed, key=_keys(key) if key is not None else (), **forest_params)
    scored = score_forest(model, test)
    keep = [c for c in test.columns] + ["prediction"]
    return model, scored.select(*keep)


def forest_metrics(scored: DataFrame, kind: str) -> DataFrame:
    m = prediction_metrics(scored, "label", "prediction", classify=(kind == "class"))
    rmse = F.col("rmse") if kind == "reg" else F.lit(None).cast("double")
    return m.select(F.lit(kind).alias("kind"), "n", rmse.alias("rmse"), "error_fraction")


def forest_experiment(df: DataFrame, label: str, features: str | Sequence[str],
                      key: str | Sequence[str] | None = None, *, kind: str = "class",
                      **params) -> DataFrame:
    """One row: kind, n, rmse (regression), error_fraction (classification)."""
    _, scored = forest_predictions(df, label, features, key, kind=kind, **params)
    return forest_metrics(scored, kind)
