"""Matrix factorisation (ALS) of a (user, item, rating) column triple.

One solver fits at every size: explicit ALS on aggregated pairs
(``pairgrade.operators.wals``).  MLlib's block ALS can be asked for; there
ratings are hash-partitioned into user and item blocks, intermediate RDDs are
kept MEMORY_AND_DISK and checkpointed every ``checkpoint_interval`` iterations
into the session's shared checkpoint folder.

Scoring joins the held-out rows with both factor tables; with the ``drop``
cold-start strategy rows whose user or item was not seen in training vanish.
MLlib's ``transform`` plans those joins as sort-merge joins (the factor
tables carry no size statistics), which shuffles the whole held-out side
twice.  ``score_als`` first measures the factor tables (they are cached by
the fit, so counting is cheap): when both fit under ``broadcast_mb`` they are
broadcast and scoring is a map-only pass over the held-out rows.  Above the
bound the rows are shuffled, but only those whose ids a Bloom filter of the
trained ids lets pass: cold rows go before the joins, not in them.  Both paths
give bit-identical predictions (same float dot product, same order of terms).
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pairgrade.operators.membership import keep_members
from pairgrade.operators.wals import PairFactors, fit_pair_factors
from pairgrade.session import checkpoint_root

# Defaults of the reference experiments.
RANK = 70
MAX_ITER = 10
REG_PARAM = 0.01
SEED = 123
# Largest factor table (estimated bytes) broadcast for scoring.
BROADCAST_FACTORS_MB = 256
_OF_MODEL = object()


def resolve_blocks(spark, num_blocks):
    """``None`` -> MLlib's default (10, reproduces published numbers);
    ``"auto"`` -> one block per default task slot (cluster runs)."""
    if num_blocks == "auto":
        return max(10, spark.sparkContext.defaultParallelism)
    return num_blocks


def als_estimator(user: str, item: str, rating: str, *, rank: int = RANK,
                  max_iter: int = MAX_ITER, reg_param: float = REG_PARAM,
                  seed: int = SEED, cold_start: str = "drop",
                  implicit: bool = False, alpha: float = 1.0,
                  nonnegative: bool = False, num_blocks: int | None = None,
                  checkpoint_interval: int = 10,
                  prediction: str = "prediction") -> ALS:
    est = ALS(
        userCol=user, itemCol=item, ratingCol=rating,
        rank=rank, maxIter=max_iter, regParam=reg_param, seed=seed,
        coldStartStrategy=cold_start, implicitPrefs=implicit, alpha=alpha,
        nonnegative=nonnegative, checkpointInterval=checkpoint_interval,
        intermediateStorageLevel="MEMORY_AND_DISK",
        finalStorageLevel="MEMORY_AND_DISK",
    )
    est = est.setPredictionCol(prediction)
    if num_blocks is not None:
        est = est.setNumUserBlocks(num_blocks).setNumItemBlocks(num_blocks)
    return est


def usable_ratings(df: DataFrame, user: str, item: str, rating: str | None = None) -> DataFrame:
    """Rows ALS can use: ids present (MLlib raises on a null id) and, for a
    training frame, a rating that is neither null nor NaN."""
    cond = F.col(user).isNotNull() & F.col(item).isNotNull()
    if rating is not None:
        cond = cond & F.col(rating).isNotNull() & ~F.isnan(F.col(rating).cast("double"))
    return df.where(cond)


def unusable(user: str, item: str, rating: str | None = None) -> Column:
    """True for the rows that ``usable_ratings`` leaves out."""
    bad = F.col(user).isNull() | F.col(item).isNull()
    if rating is not None:
        bad = bad | F.col(rating).isNull() | F.isnan(F.col(rating).cast("double"))
    return F.coalesce(bad, F.lit(False))


def dropped_ratings(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """One row: how many rows ALS cannot use (null id, null or NaN rating),
    counted in one aggregate; nothing runs until it is read."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(unusable(user, item, rating)).alias("dropped"))


SOLVERS = ("pairs", "mllib")
_COMMON = {"rank", "max_iter", "reg_param", "seed", "cold_start", "checkpoint_interval", "prediction"}
_OWN = {"pairs": {"target_pairs", "broadcast_mb"},
        "mllib": {"num_blocks", "implicit", "alpha", "nonnegative"}}


class NoRatings(ValueError):
    """No training row has both ids and a rating."""


def check_als_params(solver: str = "pairs", **params) -> None:
    """Raise on an unknown solver or parameter, or one of the other solver's,
    before any job runs."""
    if solver not in SOLVERS:
        raise ValueError(f"solver must be one of {SOLVERS}, not {solver!r}")
    for name in params.keys() - _COMMON - _OWN[solver]:
        if any(name in own for own in _OWN.values()):
            raise ValueError(f"{name!r} is not a parameter of solver {solver!r}")
        raise TypeError(f"unknown ALS parameter {name!r}")


def fit_als(train: DataFrame, user: str, item: str, rating: str, *,
            solver: str = "pairs", checked: bool = False, **params) -> ALSModel | PairFactors:
    """Fit explicit ALS.

    ``solver="pairs"`` (default, at every size): normal equations on aggregated
    pairs with salting of heavy ids (``pairgrade.operators.wals``); it survives
    an id holding a large share of the rows and collapses low-cardinality
    columns, and its numbers do not depend on the cluster.  ``solver="mllib"``:
    MLlib's block ALS (``ALSModel``); reproduces MLlib's numbers, also fits
    implicit and nonnegative ALS, and keeps all ratings of an id in one task.
    ``checked``: the caller knows that there are usable ratings."""
    check_als_params(solver, **params)
    spark = train.sparkSession
    checkpoint_root(spark)  # ALS checkpoints only when a dir is set
    clean = usable_ratings(train, user, item, rating).select(user, item, rating)
    if not checked and clean.isEmpty():  # reads at most one row
        raise NoRatings(no_ratings(user, item, rating))
    if solver == "pairs":
        return fit_pair_factors(clean, user, item, rating, **params)
    params["num_blocks"] = resolve_blocks(spark, params.get("num_blocks"))
    return als_estimator(user, item, rating, **params).fit(clean)


def no_ratings(user: str, item: str, rating: str) -> str:
    return (f"no usable ratings: every training row has a null id ({user}, {item}) "
            f"or a null/NaN rating ({rating}); a constant column scaled by "
            "min-max gives null ratings")


def _parts(model):
    """(user factors, item factors, rank, user col, item col, cold start,
    prediction col) of either model type."""
    if isinstance(model, PairFactors):
        return (model.user_factors, model.item_factors, model.rank, model.user_col,
                model.item_col, model.cold_start, model.prediction_col)
    return (model.userFactors, model.itemFactors, model.rank, model.getUserCol(),
            model.getItemCol(), model.getColdStartStrategy(), model.getPredictionCol())


def factor_table_bytes(model) -> tuple[int, int]:
    """Estimated in-memory size of the user and item factor tables:
    ids x (rank floats + row overhead).  Counts run on cached or written
    factors."""
    uf, vf, rank = _parts(model)[:3]
    per_row = rank * 4 + 32
    return uf.count() * per_row, vf.count() * per_row


def dot(a: str, b: str):
    """Float dot product, terms added left to right (as MLlib's scorer)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y),
                       F.lit(0.0).cast("float"), lambda acc, x: acc + x)


def _score_join(model, df: DataFrame, broadcast: bool) -> DataFrame:
    """Join the rows with both factor tables and take the dot product; the
    factor tables are broadcast only when ``broadcast`` (size checked)."""
    ufac, vfac, _, user, item, cold, prediction = _parts(model)
    uf = ufac.select(F.col("id").alias("__uid"), F.col("features").alias("__uf"))
    vf = vfac.select(F.col("id").alias("__iid"), F.col("features").alias("__if"))
    if broadcast:
        uf, vf = F.broadcast(uf), F.broadcast(vf)
    drop = cold == "drop"
    if drop and not broadcast:  # ids never trained on need not be shuffled
        df = keep_members(keep_members(df, user, ufac, "id"), item, vfac, "id")
    how = "inner" if drop else "left"
    joined = (df.join(uf, F.col(user).cast("int") == F.col("__uid"), how)
                .join(vf, F.col(item).cast("int") == F.col("__iid"), how))
    pred = dot("__uf", "__if")
    if not drop:
        pred = F.when(F.col("__uf").isNull() | F.col("__if").isNull(),
                      F.lit(float("nan")).cast("float")).otherwise(pred)
    return joined.select(*[df[c] for c in df.columns], pred.alias(prediction))


def score_als(model, df: DataFrame, broadcast_mb: float | None = _OF_MODEL) -> DataFrame:
    """All columns of ``df`` plus a float ``prediction``; cold rows dropped
    when the model's strategy is ``drop``.  Factor tables are broadcast only
    when their measured size is below ``broadcast_mb`` (``None``: never; by
    default the bound given to the fit); otherwise by shuffle joins, of the rows
    that a Bloom filter of the trained ids lets pass."""
    _, _, _, user, item, _, _ = _parts(model)
    if broadcast_mb is _OF_MODEL:
        broadcast_mb = getattr(model, "broadcast_mb", BROADCAST_FACTORS_MB)
    data = usable_ratings(df, user, item)
    integral = all(isinstance(df.schema[c].dataType, IntegralType) for c in (user, item))
    small = (broadcast_mb is not None and integral
             and max(factor_table_bytes(model)) <= broadcast_mb * 1024 * 1024)
    if integral or isinstance(model, PairFactors):
        return _score_join(model, data, small)
    return model.transform(data)


def factor_ids(model, side: str = "user") -> DataFrame:
    """Ids that received a factor (= distinct ids of the training rows)."""
    uf, vf = _parts(model)[:2]
    return (uf if side == "user" else vf).select(F.col("id"))
