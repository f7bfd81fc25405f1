"""Experiments and sweeps built from the operators."""

from pairgrade.plans.experiments import (
    forest_experiment, forest_predictions, pair_experiment, pair_predictions,
)
from pairgrade.plans.sweep import ordered_pairs, pair_sweep

__all__ = [
    "forest_experiment", "forest_predictions", "ordered_pairs",
    "pair_experiment", "pair_predictions", "pair_sweep",
]
