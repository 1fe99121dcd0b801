"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All read the whole driver tables (through the ``ratings`` and ``vectors``
fixtures). Factor queries use rank ``K = 4``, ``P = 8`` blocks and seed 1, and
spread the K values into columns ``f0..f3`` rounded to 6 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.functions.init import init_factors
from latentgrid.functions.vectors import axpy, dot, scale
from latentgrid.operators.evaluate import evaluate, evaluate_blocks, factor_sides, missing_id_set, predict, require_factors
from latentgrid.operators.grid import (assign_blocks, balanced_grid, block_counts, compute_grid, factor_work_key,
                                       grid_frame, inverse_work_key, rating_faults, schedule, with_offset)
from latentgrid.operators.step import balanced_keys, prepare_ratings
from latentgrid.plans import fixtures
from latentgrid.plans.fixtures import ORDER_COLS
from latentgrid.plans.train import fit, resume
from latentgrid.session import scratch_path
from latentgrid.sources.blocks import append_blocked, pack_blocks, read_stratum, unpack_blocks, write_blocked
from latentgrid.sources.factors import (factor_lines, load_factors, pack_factor_pieces, pack_factors,
                                        read_factors, unpack_factors, write_factors, write_factors_text)
from latentgrid.sources.packed import block_lines, factor_block_lines, read_packed, write_packed
from latentgrid.sources.ratings import (parse_rating_lines, prefix_sample,
                                        rating_lines, read_ratings)

P = 8
K = 4
#: Values of an embedding, all of which the factor files hold.
VECTOR_K = 64
SEED = 1
PACK_PIECE = 50
FACTOR_PIECE = 30
VECTOR_DIM = 100
EPOCHS = 2
ETA = 0.001
DECAY = 0.99


def _ratings(spark, sf_dir):
    return fixtures.ratings(spark, sf_dir)


def _grid(spark, sf_dir):
    return compute_grid(_ratings(spark, sf_dir), P)


def spread(df: DataFrame, col: str = "factors", k: int = K, decimals: int | None = 6,
           prefix: str = "f") -> DataFrame:
    """Replace an array column of length k by k scalar columns."""
    def one(i):
        v = F.get(F.col(col), i)
        return (F.round(v, decimals) if decimals is not None else v).alias(f"{prefix}{i}")
    return df.select(*[c for c in df.columns if c != col], *[one(i) for i in range(k)])


# -- scans and parsing -------------------------------------------------------

def q_ratings_scan(spark, sf_dir):
    return _ratings(spark, sf_dir)


def q_ratings_parse_text(spark, sf_dir):
    lines = rating_lines(_ratings(spark, sf_dir), ",", extra=["l_orderkey", "l_linenumber"])
    return parse_rating_lines(lines, ",", "strict")


def _dc_lines(spark, sf_dir):
    li = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(F.concat_ws("::", F.col("o_custkey").cast("string"),
                                F.col("l_partkey").cast("string"),
                                fixtures.rating_of_quantity(F.col("l_quantity")).cast("string"),
                                F.unix_timestamp("o_orderdate").cast("string")).alias("value"))


def q_ratings_parse_double_colon(spark, sf_dir):
    return parse_rating_lines(_dc_lines(spark, sf_dir), "::", "strict")


def _quarantine_lines(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    x, y, rt = (F.col(c).cast("string") for c in ("x_id", "y_id", "rating"))
    line = (F.when(F.col("l_linenumber") == 7, F.concat_ws(",", x, F.concat(F.lit("p"), y), rt))
            .when(F.col("l_quantity") == 50, F.concat_ws(",", x, y))
            .when(F.col("l_quantity") == 49, F.concat_ws(",", x, y, F.lit("n/a")))
            .otherwise(F.concat_ws(",", x, y, rt, F.col("l_orderkey").cast("string"))))
    return r.select(line.alias("value"))


def q_ratings_quarantine(spark, sf_dir):
    good, bad = parse_rating_lines(_quarantine_lines(spark, sf_dir), ",", "quarantine")
    g = good.select(F.lit("good").alias("status"), "x_id", "y_id", "rating",
                    F.lit(None).cast("string").alias("reason"))
    b = bad.select(F.lit("bad").alias("status"), F.lit(None).cast("bigint").alias("x_id"),
                   F.lit(None).cast("bigint").alias("y_id"), F.lit(None).cast("double").alias("rating"),
                   "reason")
    return g.unionByName(b)


def _prefix(spark, sf_dir, part: int):
    r = _ratings(spark, sf_dir)
    return prefix_sample(r, r.count() // part, ORDER_COLS, scratch_path(spark, "q-prefix"))


def q_ratings_prefix(spark, sf_dir):
    """The first sixth of the ratings."""
    return _prefix(spark, sf_dir, 6)


def q_ratings_prefix_large(spark, sf_dir):
    """The first half of the ratings."""
    return _prefix(spark, sf_dir, 2)


def q_ratings_text_file(spark, sf_dir):
    """S1 through real files: the fixture written as text part files, read back strictly."""
    path = scratch_path(spark, "q-ratings-text")
    rating_lines(_ratings(spark, sf_dir), ",", extra=["l_orderkey"]).write.text(path)
    return read_ratings(spark, path, ",", "strict")


def q_ratings_header_file(spark, sf_dir):
    """S3: headered CSV files (``userId,movieId,rating,timestamp``), first three columns."""
    path = scratch_path(spark, "q-ratings-csv")
    r = _ratings(spark, sf_dir)
    (r.select(F.col("x_id").alias("userId"), F.col("y_id").alias("movieId"), "rating",
              F.col("l_orderkey").alias("timestamp"))
     .write.option("header", True).csv(path))
    return read_ratings(spark, path, ",", "strict", header=True)


# -- grid, blocks, strata, schedules -------------------------------------------

def q_grid_dims(spark, sf_dir):
    return grid_frame(_ratings(spark, sf_dir), P)


def q_rating_faults(spark, sf_dir):
    """P10 on damaged ratings: ids and ratings taken away, negative ids and ids beyond the grid of the sound table."""
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    x, y, v, q = (F.col(c) for c in ("x_id", "y_id", "rating", "l_quantity"))
    damaged = r.select(F.when(F.col("l_linenumber") != 7, F.when(q == 48, -1 - x).otherwise(x)).alias("x_id"),
                       F.when(q == 47, y + P * g.y_dim).otherwise(y).alias("y_id"),
                       F.when(q == 50, F.lit(float("nan"))).when(q != 49, v).alias("rating"))
    return rating_faults(damaged, g)


def q_step_layout(spark, sf_dir):
    """Samples in each partition of each step's cached ratings; partition b holds the block of row block b, no other."""
    r = _ratings(spark, sf_dir)
    laid = prepare_ratings(r, compute_grid(r, P), "diagonal", balanced_keys(spark, P), ORDER_COLS)
    out = None
    for s in range(P):
        one = laid.part(s).select(F.lit(s).alias("step"), F.spark_partition_id().alias("xb"), F.expr("octet_length(a) div 8").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("step", "xb").agg(F.sum("n").alias("n"))


def q_block_assign(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    return assign_blocks(r, g).drop("stratum")


def q_block_offset(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    return with_offset(r, g)


def q_block_counts(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    return block_counts(r, compute_grid(r, P))


def q_stratum_rows(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    b = assign_blocks(r, compute_grid(r, P))
    return b.withColumn("work", F.col("xb"))


def q_stratum_counts(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    b = assign_blocks(r, compute_grid(r, P))
    return b.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"),
                                    F.countDistinct("xb").alias("row_blocks"),
                                    F.countDistinct("yb").alias("col_blocks"))


def _schedule_with_counts(spark, sf_dir, kind):
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    counts = block_counts(r, g).select("xb", "yb", "n")
    return schedule(spark, P, kind).join(counts, ["xb", "yb"]).select("step", "xb", "yb", "n")


def q_schedule_diagonal(spark, sf_dir):
    return _schedule_with_counts(spark, sf_dir, "diagonal")


def q_schedule_row_major(spark, sf_dir):
    return _schedule_with_counts(spark, sf_dir, "row_major")


def q_rotation_identity(spark, sf_dir):
    """P7 then P8 for every H row and every stratum: ``back`` equals ``block``."""
    g = _grid(spark, sf_dir)
    h = init_factors(spark, g, K, SEED, ratings=_ratings(spark, sf_dir)).filter(F.col("side") == "H").select("side", "id", "block")
    steps = h.select("side", "id", "block", F.explode(F.sequence(F.lit(0), F.lit(P - 1))).alias("step"))
    steps = steps.withColumn("work", factor_work_key(P, "step")).withColumn("back", inverse_work_key(P, "step", "work"))
    return steps.select("id", "block", "step", "work", "back")


# -- packed text formats ---------------------------------------------------------

def q_blocks_packed(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    return pack_blocks(r, compute_grid(r, P), ORDER_COLS, piece=PACK_PIECE)


def q_blocks_packed_file(spark, sf_dir):
    """S9 as text files: one line per block, read back by the ranges of the index."""
    r = _ratings(spark, sf_dir)
    path = scratch_path(spark, "q-packed")
    write_packed(block_lines(pack_blocks(r, compute_grid(r, P), ORDER_COLS, piece=PACK_PIECE)), path, files=3)
    return read_packed(spark, path)


def q_block_counts_balanced(spark, sf_dir):
    """P3 with edges by counts, on ids that crowd towards 0: ratings of the largest row and column block, and of the equal ranges'."""
    r = _crowded(_ratings(spark, sf_dir))
    out = None
    for name, g in (("range", compute_grid(r, P)), ("counts", balanced_grid(r, P))):
        b = assign_blocks(r, g)
        for side in ("xb", "yb"):
            one = b.groupBy(side).agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"), F.sum("n").alias("n"))
            one = one.select(F.lit(name).alias("balance"), F.lit(side).alias("side"), "largest", "n")
            out = one if out is None else out.unionByName(one)
    return out


def q_sgd_balanced(spark, sf_dir):
    """A fit on the grid with edges by counts."""
    res = fit(_crowded(_ratings(spark, sf_dir)), K, blocks=P, epochs=1, eta=ETA, decay=DECAY, seed=SEED, order_cols=ORDER_COLS,
              balance="counts")
    return _factor_out(res)


def _crowded(r):
    """Ids squared and scaled, so that most ratings have small ones."""
    return r.withColumns({c: F.expr(f"{c} * {c} div 4096") for c in ("x_id", "y_id")})


def q_ratings_blocked_stratum(spark, sf_dir):
    """Ratings stored by stratum; reading stratum 3 prunes the other folders."""
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    path = scratch_path(spark, "q-blocked")
    write_blocked(r, g, path)
    return read_stratum(spark, path, 3)


def q_ratings_appended(spark, sf_dir):
    """A store written from the orders' first lines, the others appended twice over; all strata read back."""
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    path = scratch_path(spark, "q-appended")
    write_blocked(r.where("l_linenumber <= 2"), g, path)
    append_blocked(r.where("l_linenumber > 4"), path, g)
    append_blocked(r.where("l_linenumber BETWEEN 3 AND 4"), path)
    return spark.read.parquet(path)


def q_blocks_unpacked(spark, sf_dir):
    return unpack_blocks(q_blocks_packed(spark, sf_dir))


def q_factors_init(spark, sf_dir):
    """G1 for the ids that occur in the ratings."""
    r = _ratings(spark, sf_dir)
    return spread(init_factors(spark, compute_grid(r, P), K, SEED, ratings=r), decimals=None)


def q_factors_init_stream(spark, sf_dir):
    """G1: the whole grid's rows as one seeded stream draws them, W by id, then H."""
    return spread(init_factors(spark, _grid(spark, sf_dir), K, SEED, "stream"), decimals=None)


def _vector_factors(spark, sf_dir):
    """The embeddings as factor rows: W their values, H twice these; blocks of VECTOR_DIM ids."""
    v = F.col("v")
    e = fixtures.vectors(spark, sf_dir)
    block = F.expr(f"cast(vec_id div {VECTOR_DIM} as int)").alias("block")
    return (e.select(F.lit("W").alias("side"), F.col("vec_id").alias("id"), block, v.alias("factors"))
            .unionByName(e.select(F.lit("H").alias("side"), F.col("vec_id").alias("id"), block,
                                  F.transform(v, lambda x: x * 2).alias("factors"))))


def q_factors_text(spark, sf_dir):
    f = _vector_factors(spark, sf_dir)
    w = factor_lines(f, "W", 6).withColumn("side", F.lit("W"))
    h = factor_lines(f, "H", 6).withColumn("side", F.lit("H"))
    return w.unionByName(h).select("side", "id", "line")


def q_factors_parsed(spark, sf_dir):
    from latentgrid.functions.vectors import parse_numbers
    t = q_factors_text(spark, sf_dir)
    return spread(t.select("side", "id", parse_numbers(F.col("line")).alias("factors")),
                  k=VECTOR_K, decimals=None)


def q_factors_text_file(spark, sf_dir):
    """S6 -> S5: factor text files (range-partitioned parts), read back by line number."""
    f = _vector_factors(spark, sf_dir)
    out = None
    for side in ("W", "H"):
        path = scratch_path(spark, f"q-factors-{side}")
        write_factors_text(f, side, path, files=3)
        back = read_factors(spark, path, side)
        out = back if out is None else out.unionByName(back)
    return spread(out, k=VECTOR_K, decimals=None)


def q_factors_native(spark, sf_dir):
    """Native Parquet sink and source."""
    f = _vector_factors(spark, sf_dir)
    path = scratch_path(spark, "q-factors-native")
    write_factors(f, path)
    return spread(load_factors(spark, path), k=VECTOR_K, decimals=None)


def q_factors_packed(spark, sf_dir):
    return pack_factors(_vector_factors(spark, sf_dir), decimals=6)


def q_factors_packed_pieces(spark, sf_dir):
    """S10 in records of FACTOR_PIECE rows."""
    return pack_factor_pieces(_vector_factors(spark, sf_dir), {"W": VECTOR_DIM, "H": VECTOR_DIM}, decimals=6, piece=FACTOR_PIECE)


def q_factors_packed_file(spark, sf_dir):
    """S10 as text files, one per side, read back by the ranges of their index."""
    packed = pack_factors(_vector_factors(spark, sf_dir), decimals=6)
    out = None
    for side in ("W", "H"):
        path = scratch_path(spark, f"q-packed-{side}")
        write_packed(factor_block_lines(packed, side), path, files=2)
        back = read_packed(spark, path).select(F.lit(side).alias("side"), F.col("line_no").cast("int").alias("block"), "packed")
        out = back if out is None else out.unionByName(back)
    return out


def q_factors_flattened(spark, sf_dir):
    packed = pack_factors(_vector_factors(spark, sf_dir), decimals=6)
    return spread(unpack_factors(packed, {"W": VECTOR_DIM, "H": VECTOR_DIM}), k=VECTOR_K, decimals=None)


# -- vectors -------------------------------------------------------------------------

def _vector_pairs(spark, sf_dir):
    v = fixtures.vectors(spark, sf_dir)
    nxt = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("v_next"))
    return v.join(nxt, "vec_id", "left")


def q_dot_products(spark, sf_dir):
    p = _vector_pairs(spark, sf_dir)
    return p.select("vec_id", "label", F.round(dot("v", "v"), 6).alias("self_dot"),
                    F.round(dot("v", "v_next"), 6).alias("next_dot"))


def q_vector_axpy(spark, sf_dir):
    p = _vector_pairs(spark, sf_dir).filter(F.col("v_next").isNotNull())
    p = p.select("vec_id", scale("v", 2.0).alias("scaled"), axpy("v", "v_next", 0.25).alias("stepped"))
    z = p.select("vec_id", F.posexplode(F.arrays_zip("scaled", "stepped")).alias("k", "z"))
    return z.select("vec_id", "k", F.round(F.col("z.scaled"), 6).alias("scaled"),
                    F.round(F.col("z.stepped"), 6).alias("stepped"))


# -- prediction and error --------------------------------------------------------------

def _init_model(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    return r, g, init_factors(spark, g, K, SEED)


def q_predictions(spark, sf_dir):
    r, g, f = _init_model(spark, sf_dir)
    p = predict(r, f, "error", grid=g, rank=K)
    return p.withColumn("prediction", F.round("prediction", 6))


def _segment_factors(spark, sf_dir, g):
    """W only for the customers of one market segment, H for every part."""
    cust = fixtures.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    f = init_factors(spark, g, K, SEED)
    w = f.filter(F.col("side") == "W").join(
        cust.select(F.col("c_custkey").cast("bigint").alias("id")), "id", "left_semi")
    return w.unionByName(f.filter(F.col("side") == "H"))


def q_predictions_drop(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    p = predict(r, _segment_factors(spark, sf_dir, g), "drop", grid=g, rank=K)
    return p.withColumn("prediction", F.round("prediction", 6))


def q_missing_ids(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    p = predict(r, _segment_factors(spark, sf_dir, g), "nan", grid=g, rank=K)
    return p.filter(F.isnan("prediction")).drop("prediction")


def q_missing_id_set(spark, sf_dir):
    """The ids without factors, from bitmaps."""
    r = _ratings(spark, sf_dir)
    return missing_id_set(r, _segment_factors(spark, sf_dir, compute_grid(r, P)))


def q_rmse_global(spark, sf_dir):
    r, g, f = _init_model(spark, sf_dir)
    e = evaluate(r, f, grid=g, rank=K)
    return e.select(F.round("squared_error", 4).alias("squared_error"), "n",
                    F.round("rmse", 6).alias("rmse"))


def _round_err(df):
    return df.withColumn("squared_error", F.round("squared_error", 6)).withColumn(
        "rmse", F.round("rmse", 6))


def q_rmse_blocks(spark, sf_dir):
    r, g, f = _init_model(spark, sf_dir)
    return _round_err(evaluate_blocks(r, f, g, rank=K))


def q_rmse_rollup(spark, sf_dir):
    r, g, f = _init_model(spark, sf_dir)
    e = evaluate_blocks(r, f, g, totals=True, rank=K)
    return e.withColumn("squared_error", F.round("squared_error", 4)).withColumn(
        "rmse", F.round("rmse", 6))


# -- training -------------------------------------------------------------------------------

def q_sgd_one_sample(spark, sf_dir):
    """The update rule applied to every rating on its own, from the initial factors
    (built-in column expressions only; audits the block kernel's arithmetic)."""
    r, g, f = _init_model(spark, sf_dir)
    w, h = factor_sides(f, grid=g, rank=K)
    j = r.join(w, "x_id").join(h, "y_id")
    e = F.col("rating") - dot("w", "h", k=K)
    j = j.withColumn("e", e)
    c = F.lit(-2.0) * F.col("e")
    j = j.withColumn("w2", F.zip_with("w", "h", lambda a, b: a - F.lit(ETA) * (c * b)))
    j = j.withColumn("h2", F.zip_with("h", "w2", lambda b, a: b - F.lit(ETA) * (c * a)))
    out = j.select("x_id", "y_id", *ORDER_COLS, "w2", "h2")
    out = spread(out, "w2", prefix="w")
    return spread(out, "h2", prefix="h")


def _fit(spark, sf_dir, epochs=EPOCHS, schedule_kind="diagonal", dtype="double",
         eval_every=0, init=None, eta=ETA, rank=K):
    r = _ratings(spark, sf_dir)
    return fit(r, rank, blocks=P, epochs=epochs, eta=eta, decay=DECAY, seed=SEED,
               schedule=schedule_kind, order_cols=ORDER_COLS, dtype=dtype,
               eval_every=eval_every, init=init)


def _factor_out(res, decimals=6):
    return spread(res.factors.select("side", "id", "block", "factors"), decimals=decimals)


def q_sgd_one_stratum(spark, sf_dir):
    """One step: stratum 0 only (run as a fit over the stratum's ratings)."""
    r = _ratings(spark, sf_dir)
    g = compute_grid(r, P)
    from latentgrid.operators.grid import stratum as stratum_of
    s0 = stratum_of(assign_blocks(r, g), 0).drop("xb", "yb", "stratum")
    # the grid of the whole table is kept by passing its init factors
    res = fit(s0, K, blocks=P, epochs=1, eta=ETA, decay=DECAY, seed=SEED,
              order_cols=ORDER_COLS, init=init_factors(spark, g, K, SEED), grid=g)
    return _factor_out(res)


def q_sgd_one_epoch(spark, sf_dir):
    return _factor_out(_fit(spark, sf_dir, epochs=1))


def q_sgd_fit(spark, sf_dir):
    return _factor_out(_fit(spark, sf_dir, epochs=EPOCHS))


def q_sgd_history(spark, sf_dir):
    res = _fit(spark, sf_dir, epochs=EPOCHS, eval_every=1)
    return res.history.select("epoch", "eta", F.round("squared_error", 4).alias("squared_error"),
                              "n", F.round("rmse", 6).alias("rmse"))


def q_sgd_history_blocks(spark, sf_dir):
    """Errors per epoch and block, from the blocks themselves."""
    res = _fit(spark, sf_dir, epochs=EPOCHS, eval_every=1)
    return res.errors.withColumn("squared_error", F.round("squared_error", 4))


def q_sgd_resume(spark, sf_dir):
    """A run stopped in its second epoch, after step 3, and continued."""
    path = scratch_path(spark, "q-resume")
    r = _ratings(spark, sf_dir)
    fit(r, K, blocks=P, epochs=EPOCHS, eta=ETA, decay=DECAY, seed=SEED, order_cols=ORDER_COLS, path=path, steps=P + 3)
    return _factor_out(resume(spark, path))


def q_sgd_row_major(spark, sf_dir):
    return _factor_out(_fit(spark, sf_dir, epochs=EPOCHS, schedule_kind="row_major"))


def q_sgd_warm_start(spark, sf_dir):
    first = _fit(spark, sf_dir, epochs=1)
    second = _fit(spark, sf_dir, epochs=1, init=first.factors, eta=ETA * DECAY)
    return _factor_out(second)


def q_sgd_fit_full(spark, sf_dir):
    """Reference settings: rank 30, 10 epochs (rows-only check)."""
    return _fit(spark, sf_dir, epochs=10, rank=30).factors


def q_sgd_fit_float(spark, sf_dir):
    """32-bit arithmetic (rows-only check)."""
    return _factor_out(_fit(spark, sf_dir, epochs=EPOCHS, dtype="float"), decimals=4)


def q_sgd_float_history(spark, sf_dir):
    """Errors per epoch of a fit in 32-bit arithmetic."""
    res = _fit(spark, sf_dir, epochs=EPOCHS, dtype="float", eval_every=1)
    return res.history.select("epoch", "eta", "n", F.round("rmse", 4).alias("rmse"))


def q_train_then_evaluate(spark, sf_dir):
    """Rating files read, a model trained, its factors written as text, read back and evaluated."""
    path = scratch_path(spark, "q-train")
    rating_lines(_ratings(spark, sf_dir), ",", extra=ORDER_COLS).write.text(f"{path}/ratings")
    # the lines are parsed once: the fit and the evaluation read their ratings four times
    lines = read_ratings(spark, f"{path}/ratings", ",", "strict")
    lines.write.parquet(f"{path}/parsed")
    r = spark.read.schema(lines.schema).parquet(f"{path}/parsed")
    res = fit(r, K, blocks=P, epochs=1, eta=ETA, decay=DECAY, seed=SEED)
    for side in ("W", "H"):
        write_factors_text(res.factors, side, f"{path}/{side}", files=2)
    f = read_factors(spark, f"{path}/W", "W").unionByName(read_factors(spark, f"{path}/H", "H"))
    require_factors(r, f)
    return evaluate(r, f, grid=res.grid, rank=K).select("n", F.round("squared_error", 4).alias("squared_error"), F.round("rmse", 6).alias("rmse"))


QUERIES = {
    "ratings_scan": q_ratings_scan,
    "ratings_parse_text": q_ratings_parse_text,
    "ratings_parse_double_colon": q_ratings_parse_double_colon,
    "ratings_quarantine": q_ratings_quarantine,
    "ratings_prefix": q_ratings_prefix,
    "ratings_prefix_large": q_ratings_prefix_large,
    "ratings_text_file": q_ratings_text_file,
    "ratings_header_file": q_ratings_header_file,
    "ratings_blocked_stratum": q_ratings_blocked_stratum,
    "ratings_appended": q_ratings_appended,
    "grid_dims": q_grid_dims,
    "rating_faults": q_rating_faults,
    "step_layout": q_step_layout,
    "block_assign": q_block_assign,
    "block_offset": q_block_offset,
    "block_counts": q_block_counts,
    "stratum_rows": q_stratum_rows,
    "stratum_counts": q_stratum_counts,
    "schedule_diagonal": q_schedule_diagonal,
    "schedule_row_major": q_schedule_row_major,
    "rotation_identity": q_rotation_identity,
    "blocks_packed": q_blocks_packed,
    "blocks_unpacked": q_blocks_unpacked,
    "blocks_packed_file": q_blocks_packed_file,
    "block_counts_balanced": q_block_counts_balanced,
    "factors_init": q_factors_init,
    "factors_init_stream": q_factors_init_stream,
    "factors_text": q_factors_text,
    "factors_parsed": q_factors_parsed,
    "factors_text_file": q_factors_text_file,
    "factors_native": q_factors_native,
    "factors_packed": q_factors_packed,
    "factors_packed_pieces": q_factors_packed_pieces,
    "factors_packed_file": q_factors_packed_file,
    "factors_flattened": q_factors_flattened,
    "dot_products": q_dot_products,
    "vector_axpy": q_vector_axpy,
    "predictions": q_predictions,
    "predictions_drop": q_predictions_drop,
    "missing_ids": q_missing_ids,
    "missing_id_set": q_missing_id_set,
    "rmse_global": q_rmse_global,
    "rmse_blocks": q_rmse_blocks,
    "rmse_rollup": q_rmse_rollup,
    "sgd_one_sample": q_sgd_one_sample,
    "sgd_one_stratum": q_sgd_one_stratum,
    "sgd_one_epoch": q_sgd_one_epoch,
    "sgd_fit": q_sgd_fit,
    "sgd_history": q_sgd_history,
    "sgd_history_blocks": q_sgd_history_blocks,
    "sgd_resume": q_sgd_resume,
    "sgd_balanced": q_sgd_balanced,
    "sgd_row_major": q_sgd_row_major,
    "sgd_warm_start": q_sgd_warm_start,
    "sgd_fit_full": q_sgd_fit_full,
    "sgd_fit_float": q_sgd_fit_float,
    "sgd_float_history": q_sgd_float_history,
    "train_then_evaluate": q_train_then_evaluate,
}
