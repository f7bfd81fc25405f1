"""pairgrade: predict one column of a graded-item table from the others, on Spark.

Everything is a DataFrame transformation or a ``pyspark.ml`` estimator, so the
work runs on the executors:

* ``functions``  column expressions (typed cast, fixed-point, ordinal codes,
  min-max, piecewise bias, key-hash split, class rounding)
* ``operators``  DataFrame -> DataFrame steps (scaling, split, metrics, ALS,
  random forests, tree-node table)
* ``sources``    item tables (CSV, the TPC-H stand-in), LibSVM, sinks
* ``plans``      experiments (one pair, one forest) and pair sweeps
"""

from pairgrade.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
