"""Print the formatted physical plans of the main operators.

usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from latentgrid.functions.init import init_factors  # noqa: E402
from latentgrid.operators.evaluate import evaluate  # noqa: E402
from latentgrid.operators.grid import compute_grid  # noqa: E402
from latentgrid.operators.step import StepPlanner, balanced_keys, pack_factor_records, prepare_ratings  # noqa: E402
from latentgrid.plans import fixtures  # noqa: E402
from latentgrid.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    r = fixtures.ratings(spark, sf)
    g = compute_grid(r, 8)
    f = init_factors(spark, g, 30)
    print("=== rating fixture (scan, pruning, join) ===")
    r.explain("formatted")
    print("=== evaluate (size-checked broadcast of W and H) ===")
    evaluate(r, f, grid=g, rank=30).explain("formatted")
    keys = balanced_keys(spark, g.p)
    order = ["x_id", "y_id", "rating"]
    prep = prepare_ratings(r.select("x_id", "y_id", "rating"), g, "diagonal", keys, order)
    pl = StepPlanner(prep, g, keys, "diagonal", "double", 30)
    records = pack_factor_records(f, 30)
    step = pl.step(records, 1, 0.001)
    step.write.format("noop").mode("overwrite").save()
    print("=== training step 1 (after its ratings were cached) ===")
    step.explain("formatted")
    print("=== errors per block ===")
    pl.errors(records).explain("formatted")
    prep.unpersist()


if __name__ == "__main__":
    main()
