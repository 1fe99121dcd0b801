"""RMSE of saved factors on a rating file.

spark-submit jobs/evaluate.py W H RATINGS            (text factors, line number = id)
spark-submit jobs/evaluate.py --native PATH RATINGS  (Parquet factors)
Prints ``Calculated_RMSE=%f``.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from latentgrid.operators.evaluate import evaluate, require_factors  # noqa: E402
from latentgrid.sources.factors import load_factors, read_factors  # noqa: E402
from latentgrid.sources.ratings import read_ratings  # noqa: E402


def main(argv=None) -> None:
    a = argparse.ArgumentParser()
    a.add_argument("paths", nargs="+")
    a.add_argument("--native")
    a.add_argument("--sep", default=",")
    a.add_argument("--header", action="store_true")
    a.add_argument("--mode", choices=["strict", "drop"], default="strict")
    a.add_argument("--on-missing", choices=["error", "drop", "nan"], default="error")
    args = a.parse_args(argv)
    spark = SparkSession.builder.appName("latentgrid-evaluate").getOrCreate()
    if args.native:
        factors = load_factors(spark, args.native)
        data = args.paths[0]
    else:
        if len(args.paths) != 3:
            raise SystemExit("usage: evaluate.py <w> <h> <data>")
        w, h, data = args.paths
        factors = read_factors(spark, w, "W").unionByName(read_factors(spark, h, "H"))
    ratings = read_ratings(spark, data, sep=args.sep, mode=args.mode, header=args.header)
    if args.on_missing == "error":
        require_factors(ratings, factors)
    e = evaluate(ratings, factors, on_missing=args.on_missing).first()
    rmse = float("nan") if e["rmse"] is None else e["rmse"]
    print("Calculated_RMSE=%f" % rmse)


if __name__ == "__main__":
    main()
