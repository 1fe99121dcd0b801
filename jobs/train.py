"""Train a factor model.

spark-submit --py-files latentgrid.zip jobs/train.py --ratings R --rank 30 --out-w W --out-h H
    [--blocks 8] [--epochs 10] [--eta 0.001] [--decay 0.99] [--seed 1]
    [--schedule diagonal|row_major] [--eval-every 0] [--sep ,] [--mode strict]
    [--out PATH] [--dtype double|float] [--init PATH | --init-w W --init-h H] [--init-method hash|stream]
    [--ids grid|seen] [--run FOLDER]
spark-submit jobs/train.py --resume FOLDER --out-w W --out-h H

Output paths are checked before training starts. Evaluated epochs are printed as they end.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from latentgrid.operators.grid import compute_grid  # noqa: E402
from latentgrid.plans.train import fit, resume  # noqa: E402
from latentgrid.session import ensure_checkpoint_dir, path_exists  # noqa: E402
from latentgrid.sources.factors import (load_factors, read_factors, with_blocks,  # noqa: E402
                                        write_factors, write_factors_text)
from latentgrid.sources.ratings import read_ratings  # noqa: E402


def parse_args(argv=None):
    a = argparse.ArgumentParser(description="fit W and H by blocked SGD")
    a.add_argument("--ratings")
    a.add_argument("--rank", type=int)
    a.add_argument("--out-w")
    a.add_argument("--out-h")
    a.add_argument("--out", help="native Parquet output (partitioned by side)")
    a.add_argument("--blocks", type=int, default=8, help="block count P")
    a.add_argument("--epochs", type=int, default=10)
    a.add_argument("--eta", type=float, default=0.001)
    a.add_argument("--decay", type=float, default=0.99)
    a.add_argument("--seed", type=int, default=1)
    a.add_argument("--schedule", choices=["diagonal", "row_major"], default="diagonal")
    a.add_argument("--eval-every", type=int, default=0)
    a.add_argument("--sep", default=",")
    a.add_argument("--header", action="store_true")
    a.add_argument("--splits", type=int, help="least number of tasks that read the ratings (default: the block count)")
    a.add_argument("--mode", choices=["strict", "drop"], default="strict")
    a.add_argument("--dtype", choices=["double", "float"], default="double")
    a.add_argument("--init", help="warm start from native factors")
    a.add_argument("--init-w", help="warm start from factor text (with --init-h)")
    a.add_argument("--init-h")
    a.add_argument("--init-method", choices=["hash", "stream"], default="hash")
    a.add_argument("--run", help="folder of the run, kept when it stops before its end")
    a.add_argument("--resume", help="continue the run in this folder (--ratings and --rank aren't needed)")
    a.add_argument("--text-files", type=int, default=None)
    a.add_argument("--ids", choices=["grid", "seen"], default="grid",
                   help="factor rows for every id of the grid, or only for ids in the ratings")
    args = a.parse_args(argv)
    if not args.resume and (args.ratings is None or args.rank is None):
        a.error("--ratings and --rank are required, but for --resume")
    if bool(args.init_w) != bool(args.init_h):
        a.error("--init-w and --init-h go together")
    return args


def report(row: dict) -> None:
    """One line per evaluated epoch, as it ends."""
    print(row["epoch"], round(row["seconds"], 3), row["squared_error"], row["rmse"], flush=True)


def _train(spark, args):
    ratings = read_ratings(spark, args.ratings, sep=args.sep, mode=args.mode, header=args.header,
                           splits=args.splits or args.blocks)
    init = None
    if args.init:
        init = load_factors(spark, args.init)
    elif args.init_w:
        text = read_factors(spark, args.init_w, "W").unionByName(read_factors(spark, args.init_h, "H"))
        grid = compute_grid(ratings, args.blocks)
        init = with_blocks(text, grid.x_dim, grid.y_dim)
    return fit(ratings, args.rank, blocks=args.blocks, epochs=args.epochs, eta=args.eta,
               decay=args.decay, seed=args.seed, schedule=args.schedule, dtype=args.dtype,
               init=init, init_method=args.init_method, eval_every=args.eval_every, ids=args.ids, path=args.run, on_epoch=report)


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("latentgrid-train").getOrCreate()
    ensure_checkpoint_dir(spark)
    outs = [p for p in (args.out_w, args.out_h, args.out) if p]
    if not outs:
        raise SystemExit("give --out-w/--out-h (text) or --out (parquet)")
    for p in outs:
        if path_exists(spark, p):
            raise SystemExit(f"output exists: {p}")
    if args.ids == "seen" and (args.out_w or args.out_h):
        raise SystemExit("text output numbers rows by line and needs every id; "
                         "use --out (Parquet) with --ids seen")
    res = resume(spark, args.resume, on_epoch=report) if args.resume else _train(spark, args)
    if args.out:
        write_factors(res.factors, args.out)
    if args.out_w:
        write_factors_text(res.factors, "W", args.out_w, files=args.text_files)
    if args.out_h:
        write_factors_text(res.factors, "H", args.out_h, files=args.text_files)
    print(json.dumps({"grid": res.grid.__dict__, "etas": res.etas}))
    res.cleanup()


if __name__ == "__main__":
    main()
