"""DataFrame -> DataFrame operators."""

from pairgrade.operators.factor import (
    dropped_ratings, factor_ids, factor_table_bytes, fit_als, score_als,
)
from pairgrade.operators.forest import (
    assemble, fit_forest, forest_nodes, score_forest, slice_features,
)
from pairgrade.operators.metrics import prediction_metrics
from pairgrade.operators.scale import minmax_bounds, minmax_scale, minmax_unit
from pairgrade.operators.split import hash_split, with_split

__all__ = [
    "assemble", "dropped_ratings", "factor_ids", "factor_table_bytes", "fit_als", "fit_forest", "forest_nodes",
    "hash_split", "minmax_bounds", "minmax_scale", "minmax_unit",
    "prediction_metrics", "score_als", "score_forest", "slice_features",
    "with_split",
]
