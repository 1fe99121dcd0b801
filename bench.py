"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Training: fixture ratings (lineitem x orders), rank 30, 10 epochs, eta 0.001,
decay 0.99, P = 8 and P = 4, with RMSE after every epoch.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from latentgrid.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    epochs = int(os.environ.get("BENCH_EPOCHS", "10"))
    spark = build_session(master=f"local[{cpus}]", app="latentgrid-bench",
                          shuffle_partitions=int(cpus))
    from latentgrid.plans import queries as Q
    from latentgrid.plans import fixtures
    from latentgrid.plans.train import fit

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    extra: dict = {}
    errors: dict[str, str] = {}
    for name in ["ratings_scan", "grid_dims", "block_counts", "stratum_counts", "blocks_packed",
                 "factors_init", "predictions", "rmse_global", "rmse_blocks", "rmse_rollup"]:
        t = time.time()
        try:
            run(Q.QUERIES[name](spark, sf_dir))
            timings[name] = round(time.time() - t, 3)
        except Exception as ex:  # noqa: BLE001 - record and go on, the JSON line must print
            errors[name] = str(ex)[:300]

    ratings = fixtures.ratings(spark, sf_dir)
    for p in (8, 4):
        t = time.time()
        try:
            res = fit(ratings, 30, blocks=p, epochs=epochs, eta=0.001, decay=0.99, seed=1,
                      eval_every=1)
            hist = res.history.orderBy("epoch").collect()
        except Exception as ex:  # noqa: BLE001
            errors[f"fit_p{p}"] = str(ex)[:300]
            continue
        total = time.time() - t
        timings[f"fit_p{p}_k30_e{epochs}"] = round(total, 3)
        secs = [h["seconds"] for h in hist]
        per_epoch = sorted(b - a for a, b in zip([0.0] + secs[:-1], secs))
        extra[f"fit_p{p}"] = {
            "sec_per_epoch": round(total / max(epochs, 1), 3),
            "median_epoch_sec": round(per_epoch[len(per_epoch) // 2], 3) if per_epoch else None,
            "rmse_per_epoch": [round(h["rmse"], 6) for h in hist],
            "seconds_at_epoch": [round(h["seconds"], 3) for h in hist],
        }
        res.cleanup()

    out = {"metric": "total_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
           "cpus": int(cpus), "training": extra}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
