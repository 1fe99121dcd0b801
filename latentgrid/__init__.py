"""latentgrid: low-rank factor models fitted by blocked, stratified SGD on Spark.

Ratings are ``(x_id, y_id, rating)`` DataFrames; factors are DataFrames with one
row per id ``(side, id, block, factors)``. Training runs as a chain of Spark
jobs (one per stratum step) whose only Python part is the per-block update.
"""

from latentgrid.operators.grid import Grid, compute_grid, assign_blocks
from latentgrid.functions.init import init_factors
from latentgrid.operators.evaluate import predict, evaluate, evaluate_blocks
from latentgrid.plans.train import fit, resume, FitResult

__all__ = [
    "Grid",
    "compute_grid",
    "assign_blocks",
    "init_factors",
    "predict",
    "evaluate",
    "evaluate_blocks",
    "fit",
    "resume",
    "FitResult",
]
