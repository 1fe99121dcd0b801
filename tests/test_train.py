import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, data
from latentgrid.functions.init import init_factors
from latentgrid.operators.grid import Grid, compute_grid
from serial_sgd import sgd_serial
from latentgrid.operators import step as step_module
from latentgrid.operators.step import balanced_keys, factor_rows_of, pack_factor_records, prepare_ratings
from latentgrid.plans import fixtures
from latentgrid.plans.train import FactorStore, fit, resume
from latentgrid.session import list_names
from latentgrid.sources.ratings import read_ratings

K = 4


def as_dict(df):
    return {(r["side"], r["id"]): np.array(r["factors"]) for r in df.collect()}


def serial_fit(spark, pdf, grid, k, epochs, order, schedule="diagonal", eta=0.001, decay=0.99):
    init = as_dict(init_factors(spark, grid, k))
    W = np.array([init[("W", i)] for i in range(grid.p * grid.x_dim)])
    H = np.array([init[("H", i)] for i in range(grid.p * grid.y_dim)])
    pdf = pdf.copy()
    pdf["xb"] = pdf.x_id // grid.x_dim
    pdf["yb"] = pdf.y_id // grid.y_dim
    pdf["step"] = (pdf.yb - pdf.xb) % grid.p if schedule == "diagonal" else pdf.xb + pdf.yb
    pdf = pdf.sort_values(["step", "xb"] + order, kind="stable")
    for _ in range(epochs):
        sgd_serial(W, H, pdf.x_id.values, pdf.y_id.values, pdf.rating.values, eta)
        eta *= decay
    return W, H


def max_diff(got, W, H):
    return max(np.abs((W[i] if s == "W" else H[i]) - v).max() for (s, i), v in got.items())


@pytest.fixture(scope="module")
def slice_ratings(spark):
    return fixtures.ratings_slice(spark, SF_SMALL).persist()


@pytest.mark.parametrize("schedule", ["diagonal", "row_major"])
def test_fit_equals_serial(spark, slice_ratings, schedule):
    res = fit(slice_ratings, K, blocks=4, epochs=2, order_cols=fixtures.ORDER_COLS,
              schedule=schedule)
    W, H = serial_fit(spark, slice_ratings.toPandas(), res.grid, K, 2, fixtures.ORDER_COLS,
                      schedule)
    assert max_diff(as_dict(res.factors), W, H) < 1e-12
    res.cleanup()


def test_one_block_is_plain_serial(spark, slice_ratings):
    a = fit(slice_ratings, K, blocks=1, epochs=1, order_cols=fixtures.ORDER_COLS)
    b = fit(slice_ratings, K, blocks=1, epochs=1, order_cols=fixtures.ORDER_COLS,
            schedule="row_major")
    pdf = slice_ratings.toPandas().sort_values(fixtures.ORDER_COLS)
    init = as_dict(init_factors(spark, a.grid, K))
    W = np.array([init[("W", i)] for i in range(a.grid.x_dim)])
    H = np.array([init[("H", i)] for i in range(a.grid.y_dim)])
    sgd_serial(W, H, pdf.x_id.values, pdf.y_id.values, pdf.rating.values, 0.001)
    assert max_diff(as_dict(a.factors), W, H) < 1e-12
    assert max_diff(as_dict(b.factors), W, H) < 1e-12


def test_epochs_zero_returns_init(spark, slice_ratings):
    res = fit(slice_ratings, K, blocks=4, epochs=0)
    assert as_dict(res.factors).keys() == as_dict(init_factors(spark, res.grid, K)).keys()
    a, b = as_dict(res.factors), as_dict(init_factors(spark, res.grid, K))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_untouched_ids_bit_unchanged(spark):
    r = read_ratings(spark, data("gaps.csv"))
    res = fit(r, 3, blocks=4, epochs=3, eta=0.01)
    got = as_dict(res.factors)
    init = as_dict(init_factors(spark, res.grid, 3))
    assert len(got) == 2 * 4 * 5
    seen_x, seen_y = {0, 5, 17}, {0, 5, 17}
    for (side, i), v in got.items():
        seen = seen_x if side == "W" else seen_y
        if i in seen:
            assert not np.array_equal(v, init[(side, i)])
        else:
            assert np.array_equal(v, init[(side, i)])


def test_shuffle_partitions_do_not_change_result(spark, slice_ratings):
    a = as_dict(fit(slice_ratings, K, blocks=3, epochs=1, order_cols=fixtures.ORDER_COLS).factors)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = as_dict(fit(slice_ratings, K, blocks=3, epochs=1, order_cols=fixtures.ORDER_COLS).factors)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_warm_start_equals_longer_fit(spark, slice_ratings):
    two = as_dict(fit(slice_ratings, K, blocks=4, epochs=2, order_cols=fixtures.ORDER_COLS).factors)
    one = fit(slice_ratings, K, blocks=4, epochs=1, order_cols=fixtures.ORDER_COLS)
    again = fit(slice_ratings, K, blocks=4, epochs=1, eta=0.001 * 0.99,
                order_cols=fixtures.ORDER_COLS, init=one.factors)
    b = as_dict(again.factors)
    assert all(np.array_equal(two[k], b[k]) for k in two)


def test_float_close_to_double(spark, slice_ratings):
    d = as_dict(fit(slice_ratings, K, blocks=4, epochs=1).factors)
    f = fit(slice_ratings, K, blocks=4, epochs=1, dtype="float")
    assert f.factors.schema["factors"].dataType.elementType.simpleString() == "float"
    fd = as_dict(f.factors)
    assert max(np.abs(d[k] - fd[k]).max() for k in d) < 1e-5


def test_history_decreases(spark, slice_ratings):
    res = fit(slice_ratings, K, blocks=4, epochs=3, eval_every=1)
    h = [r["rmse"] for r in res.history.orderBy("epoch").collect()]
    assert len(h) == 3 and h[0] > h[1] > h[2]


def test_balanced_keys_place_blocks(spark):
    for n in (3, 8, 13):
        keys = balanced_keys(spark, n)
        df = spark.createDataFrame([(k,) for k in keys], "wk long").repartition(n, "wk")
        got = {r["wk"]: r["pid"] for r in df.select("wk", F.spark_partition_id().alias("pid")).collect()}
        assert [got[k] for k in keys] == list(range(n))


def test_step_plan_shuffles_factors_only(spark, slice_ratings):
    from latentgrid.operators.step import StepPlanner
    g = compute_grid(slice_ratings, 4)
    keys = balanced_keys(spark, 4)
    prep = prepare_ratings(slice_ratings, g, "diagonal", keys, ["x_id", "y_id", "rating"])
    pl = StepPlanner(prep, g, keys, "diagonal", "double", K)
    out = pl.step(pack_factor_records(init_factors(spark, g, K), K).checkpoint(), 1, 0.001)
    out.write.format("noop").mode("overwrite").save()     # materialises the step's cache
    plan = out._jdf.queryExecution().executedPlan().toString()
    cached = prep.part(1)._jdf.queryExecution().executedPlan().toString()
    # the step's ratings were shuffled once into their cache; the step itself
    # adds one exchange (the factor side) and one secondary sort
    assert "InMemoryTableScan" in plan
    assert plan.count("Exchange hashpartitioning") == 1 + cached.count("Exchange hashpartitioning")
    assert plan.count("Sort [wk") == 1 + cached.count("Sort [wk")
    # one cached partition per block: P partitions, each a single block key
    parts = prep.part(1).groupBy(F.spark_partition_id().alias("pid")).agg(
        F.countDistinct("wk").alias("k")).collect()
    assert all(r["k"] == 1 for r in parts)
    prep.unpersist()


def test_missing_factor_row_fails(spark, slice_ratings):
    g = compute_grid(slice_ratings, 4)
    init = init_factors(spark, g, K).filter(~((F.col("side") == "W") & (F.col("id") == 3)))
    with pytest.raises(Exception, match="no factor row"):
        fit(slice_ratings, K, blocks=4, epochs=1, init=init).factors.count()


@pytest.mark.parametrize("parts", [1, 5])
def test_stream_init_is_one_sequence(spark, slice_ratings, parts):
    from latentgrid.functions.init import PARTS, factor_rows, stream_states
    g = compute_grid(slice_ratings, 4)
    f = as_dict(init_factors(spark, g, 5, seed=7, method="stream").repartition(parts))
    states, want = list(stream_states(7)), []
    for _ in range(5 * 4 * (g.x_dim + g.y_dim)):
        states = [s * a % m for s, (m, a) in zip(states, PARTS)]
        z = (states[0] - states[1]) % (PARTS[0][0] - 1) or PARTS[0][0] - 1
        want.append(z / PARTS[0][0])
    rows = [f[("W", i)] for i in range(4 * g.x_dim)] + [f[("H", i)] for i in range(4 * g.y_dim)]
    assert np.array_equal(np.concatenate(rows), np.array(want))
    seen = as_dict(init_factors(spark, g, 5, seed=7, method="stream", ratings=slice_ratings))
    assert all(np.array_equal(seen[k], f[k]) for k in seen)
    # far on in the stream, as a task jumps there
    far = 10**15
    row = factor_rows(spark, "W", 0, 10**12, 3, seed=2, method="stream", ids=spark.range(far, far + 1)).first()["factors"]
    s = [s * pow(a, 3 * far + 1, m) % m for s, (m, a) in zip(stream_states(2), PARTS)]
    assert row[0] == ((s[0] - s[1]) % (PARTS[0][0] - 1) or PARTS[0][0] - 1) / PARTS[0][0]


def test_hash_init_is_deterministic_and_uniform(spark, slice_ratings):
    g = compute_grid(slice_ratings, 4)
    a = as_dict(init_factors(spark, g, 8))
    b = as_dict(init_factors(spark.newSession(), g, 8))
    assert all(np.array_equal(a[k], b[k]) for k in a)
    v = np.concatenate(list(a.values()))
    assert 0 <= v.min() and v.max() < 1 and abs(v.mean() - 0.5) < 0.05


@pytest.mark.parametrize("schedule", ["diagonal", "row_major"])
def test_blocks_streamed_in_many_batches(spark, slice_ratings, schedule):
    """Blocks spanning many Arrow batches (factor rows and ratings split across
    batches) give the serial result."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "37")
    try:
        res = fit(slice_ratings, K, blocks=2, epochs=2, order_cols=fixtures.ORDER_COLS,
                  schedule=schedule)
        got = as_dict(res.factors)
    finally:
        spark.conf.set(key, old)
    W, H = serial_fit(spark, slice_ratings.toPandas(), res.grid, K, 2, fixtures.ORDER_COLS,
                      schedule)
    assert max_diff(got, W, H) < 1e-12


def test_hot_row_id(spark):
    """One x id holds a third of all ratings: exact result, nothing dropped."""
    r = fixtures.ratings(spark, SF_SMALL)
    hot = r.withColumn("x_id", F.when(F.col("l_linenumber") <= 2, F.lit(7).cast("bigint"))
                       .otherwise(F.col("x_id")))
    n_hot = hot.filter("x_id = 7").count()
    assert n_hot >= hot.count() / 4
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "500")
    try:
        res = fit(hot, K, blocks=4, epochs=1, order_cols=fixtures.ORDER_COLS)
        got = as_dict(res.factors)
    finally:
        spark.conf.set(key, old)
    W, H = serial_fit(spark, hot.toPandas(), res.grid, K, 1, fixtures.ORDER_COLS)
    assert max_diff(got, W, H) < 1e-12


def test_seen_ids_only_match_dense_fit(spark, slice_ratings):
    dense = as_dict(fit(slice_ratings, K, blocks=4, epochs=2, order_cols=fixtures.ORDER_COLS).factors)
    sparse = as_dict(fit(slice_ratings, K, blocks=4, epochs=2, order_cols=fixtures.ORDER_COLS,
                         ids="seen").factors)
    nx = slice_ratings.select("x_id").distinct().count()
    ny = slice_ratings.select("y_id").distinct().count()
    assert len(sparse) == nx + ny < len(dense)
    assert all(np.array_equal(sparse[k], dense[k]) for k in sparse)


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_initial_step_plan_keeps_partitioning(spark, slice_ratings, aqe):
    """Planned before anything runs, a step has exactly one exchange (the factor
    side): the union keeps the cached ratings' partitioning, with and without
    adaptive execution."""
    from latentgrid.operators.step import StepPlanner
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        g = compute_grid(slice_ratings, 4)
        keys = balanced_keys(spark, 4)
        prep = prepare_ratings(slice_ratings, g, "diagonal", keys, ["x_id", "y_id", "rating"])
        pl = StepPlanner(prep, g, keys, "diagonal", "double", K)
        records = pack_factor_records(init_factors(spark, g, K), K).checkpoint()
        out = pl.step(records, 2, 0.001)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "ENSURE_REQUIREMENTS" not in plan
        got = as_dict(factor_rows_of(out, K))
        assert len(got) == 4 * (g.x_dim + g.y_dim)
        errors = pl.errors(records)._jdf.queryExecution().executedPlan().toString()
        own = errors.split("InMemoryRelation")[0]
        assert "ENSURE_REQUIREMENTS" not in errors and "Join" not in errors and "Broadcast" not in errors
        assert own.count("Exchange hashpartitioning") <= 1
        prep.unpersist()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def ratings_of(spark, rows):
    return spark.createDataFrame(rows, "x_id long, y_id long, rating double")


GOOD = [(0, 0, 1.0), (1, 2, 3.0), (2, 1, 5.0), (3, 3, 2.0)]


@pytest.mark.parametrize("schedule", ["diagonal", "row_major"])
@pytest.mark.parametrize("row, message", [
    ((None, 1, 2.0), "null id"), ((1, None, 2.0), "null id"),
    ((1, 1, None), "null or NaN"), ((1, 1, float("nan")), "null or NaN")])
def test_incomplete_ratings_raise(spark, schedule, row, message):
    with pytest.raises(ValueError, match=message):
        fit(ratings_of(spark, [*GOOD, row]), K, blocks=2, epochs=1, schedule=schedule)


@pytest.mark.parametrize("schedule", ["diagonal", "row_major"])
def test_ratings_outside_the_grid_raise(spark, schedule):
    g = compute_grid(ratings_of(spark, GOOD), 2)
    with pytest.raises(ValueError, match="outside the grid"):
        fit(ratings_of(spark, [*GOOD, (9, 9, 1.0)]), K, blocks=2, epochs=1, schedule=schedule, grid=g)


@pytest.mark.parametrize("schedule", ["diagonal", "row_major"])
def test_every_rating_is_used(spark, slice_ratings, schedule):
    res = fit(slice_ratings, K, blocks=4, epochs=1, eval_every=1, schedule=schedule)
    assert res.history.first()["n"] == slice_ratings.count()


def test_rank_must_be_that_of_init(spark):
    r = ratings_of(spark, GOOD)
    init = init_factors(spark, compute_grid(r, 2), 6)
    with pytest.raises(ValueError, match="do not have 4 values"):
        fit(r, 4, blocks=2, epochs=1, init=init)


def test_vectors_of_another_length_raise_in_evaluation(spark):
    from latentgrid.operators.evaluate import evaluate
    r = ratings_of(spark, GOOD)
    f = init_factors(spark, compute_grid(r, 2), 6)
    assert evaluate(r, f, rank=6).first()["n"] == len(GOOD)
    with pytest.raises(Exception, match="different length"):
        evaluate(r, f, rank=4).first()
    with pytest.raises(Exception, match="null rating"):
        evaluate(ratings_of(spark, [*GOOD, (1, 1, None)]), f, rank=6).first()


@pytest.mark.parametrize("schedule", ["diagonal", "row_major"])
def test_records_of_few_samples_and_rows(spark, slice_ratings, schedule, monkeypatch):
    """Blocks spread over many rating and factor records give the serial result."""
    monkeypatch.setattr(step_module, "PIECE", 11)
    monkeypatch.setattr(step_module, "ROWS", 3)
    res = fit(slice_ratings, K, blocks=3, epochs=2, order_cols=fixtures.ORDER_COLS, schedule=schedule)
    W, H = serial_fit(spark, slice_ratings.toPandas(), res.grid, K, 2, fixtures.ORDER_COLS, schedule)
    got = as_dict(res.factors)
    assert len(got) == 3 * (res.grid.x_dim + res.grid.y_dim)
    assert max_diff(got, W, H) < 1e-12


@pytest.mark.parametrize("schedule, stops", [("diagonal", (0, 5, 1)), ("row_major", (9, 0, 4))])
def test_resumed_run_equals_one_run(spark, slice_ratings, scratch, schedule, stops):
    args = dict(blocks=4, epochs=2, order_cols=fixtures.ORDER_COLS, schedule=schedule, eval_every=1)
    whole = fit(slice_ratings, K, **args)
    part = fit(slice_ratings, K, **args, path=scratch + "/run", steps=stops[0])
    for n in stops[1:]:
        assert not part.finished
        part = resume(spark, scratch + "/run", steps=n)
    rows = []
    part = resume(spark, scratch + "/run", on_epoch=rows.append)
    assert part.finished and part.etas == whole.etas and rows[-1]["epoch"] == 1
    a, b = as_dict(whole.factors), as_dict(part.factors)
    assert all(np.array_equal(a[k], b[k]) for k in a) and a.keys() == b.keys()
    for x, y in zip(whole.history.orderBy("epoch").collect(), part.history.orderBy("epoch").collect(), strict=True):
        assert (x.epoch, x.n) == (y.epoch, y.n) and x.squared_error == pytest.approx(y.squared_error, rel=1e-12)
    assert sorted(map(tuple, whole.errors.collect())) == sorted(map(tuple, part.errors.collect()))
    again = as_dict(resume(spark, scratch + "/run").factors)
    assert all(np.array_equal(a[k], again[k]) for k in a)
    with pytest.raises(FileExistsError):
        fit(slice_ratings, K, **args, path=scratch + "/run")


def test_failed_run_goes_on(spark, slice_ratings, scratch, monkeypatch):
    """A step that fails leaves the run at the step before it."""
    args = dict(blocks=3, epochs=2, order_cols=fixtures.ORDER_COLS)
    real, calls = FactorStore.write, []

    def failing(self, records, path):
        calls.append(path)
        real(self, records, path)
        if len(calls) == 5:
            raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(FactorStore, "write", failing)
        with pytest.raises(OSError) as caught:
            fit(slice_ratings, K, **args, path=scratch + "/run")
    assert "resume(" in caught.value.__notes__[0]
    a, b = as_dict(fit(slice_ratings, K, **args).factors), as_dict(resume(spark, scratch + "/run").factors)
    assert all(np.array_equal(a[k], b[k]) for k in a)
    with pytest.raises(FileNotFoundError):
        resume(spark, scratch + "/none")


def test_waves_open_the_folders_of_their_blocks_only(spark, slice_ratings, monkeypatch):
    opened, real = [], FactorStore.read

    def read(self, blocks):
        df = real(self, blocks)
        opened.append((sorted(blocks), sorted("/".join(f.split("/")[-3:-1]) for f in df.inputFiles())))
        return df

    monkeypatch.setattr(FactorStore, "read", read)
    fit(slice_ratings, K, blocks=3, epochs=2, schedule="row_major")
    waves = opened[:-1]
    assert [len(b) for b, _ in waves] == [2, 4, 6, 4, 2] * 2
    assert all(files == sorted(f"s={s}/b={b}" for s, b in blocks) for blocks, files in waves)


@pytest.mark.parametrize("schedule", ["diagonal", "row_major"])
def test_errors_per_block_equal_the_joins(spark, slice_ratings, schedule):
    from latentgrid.operators.evaluate import evaluate_blocks
    res = fit(slice_ratings, K, blocks=4, epochs=1, eval_every=1, schedule=schedule, dtype="float")
    got = {(r.xb, r.yb): (r.squared_error, r.n) for r in res.errors.collect()}
    want = {(r.xb, r.yb): (r.squared_error, r.n) for r in evaluate_blocks(
        slice_ratings, res.factors.withColumn("factors", F.col("factors").cast("array<double>")), res.grid, rank=K).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-9 * max(1, want[k][0]) for k in got)


def test_edges_by_counts(spark):
    """Ids that crowd: the largest row block holds at most half of what the equal ranges' does, and the fit equals serial SGD."""
    from latentgrid.operators.grid import assign_blocks, balanced_grid
    r = fixtures.ratings(spark, SF_SMALL).withColumns({c: F.expr(f"{c} * {c} div 64") for c in ("x_id", "y_id")})
    g, even = balanced_grid(r, 6), compute_grid(r, 6)

    def largest(grid):
        return [assign_blocks(r, grid).groupBy(b).count().agg(F.max("count")).first()[0] for b in ("xb", "yb")]

    print("largest row and column block:", largest(even), largest(g), "of", r.count())
    assert all(2 * a <= b for a, b in zip(largest(g), largest(even)))
    res = fit(r, K, blocks=6, epochs=2, order_cols=fixtures.ORDER_COLS, balance="counts")
    assert (res.grid.x_edges, res.grid.y_edges) == (g.x_edges, g.y_edges)
    init = as_dict(init_factors(spark, res.grid, K))
    W = np.array([init[("W", i)] for i in range(g.p * g.x_dim)])
    H = np.array([init[("H", i)] for i in range(g.p * g.y_dim)])
    pdf = r.toPandas()
    pdf["xb"] = np.searchsorted(g.x_edges, pdf.x_id, "right")
    pdf["step"] = (np.searchsorted(g.y_edges, pdf.y_id, "right") - pdf.xb) % 6
    pdf = pdf.sort_values(["step", "xb"] + fixtures.ORDER_COLS, kind="stable")
    eta = 0.001
    for _ in range(2):
        sgd_serial(W, H, pdf.x_id.values, pdf.y_id.values, pdf.rating.values, eta)
        eta *= 0.99
    assert max_diff(as_dict(res.factors), W, H) < 1e-12


@pytest.mark.parametrize("schedule", ["diagonal", "row_major"])
def test_edges_by_counts_with_an_id_of_many_ratings(spark, schedule):
    rows = [(5, k % 7, float(k % 5)) for k in range(60)] + [(k % 9, k % 4, 1.0) for k in range(40)]
    r = ratings_of(spark, rows)
    whole = fit(r, K, blocks=4, epochs=1, balance="counts", schedule=schedule, eval_every=1, ids="seen")
    assert whole.history.first()["n"] == 100 and whole.factors.count() == 9 + 7
    path = whole.path + "-part"
    fit(r, K, blocks=4, epochs=1, balance="counts", schedule=schedule, eval_every=1, ids="seen", path=path, steps=2)
    a, b = as_dict(whole.factors), as_dict(resume(spark, path).factors)
    assert all(np.array_equal(a[k], b[k]) for k in a)


@pytest.mark.parametrize("method, dtype", [("hash", "double"), ("stream", "float")])
def test_steps_work_on_rated_ids_only(spark, scratch, method, dtype):
    """The grid has 4,000 rows a side; the steps move the rated ones, and the others keep their first values."""
    r = spark.createDataFrame([(i, j, 1.0 + (i + j) % 5) for i in (0, 63, 64, 3999) for j in (5, 128, 3000)], "x_id long, y_id long, rating double")
    path = scratch + "/run"
    res = fit(r, K, blocks=4, epochs=1, init_method=method, dtype=dtype, path=path, keep_steps=True)
    held = spark.read.parquet(f"{path}/factors-00000000").selectExpr("side", "octet_length(ids) div 8 AS n").groupBy("side").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, held.collect())) == [("H", 3), ("W", 4)]
    first = as_dict(init_factors(spark, res.grid, K, 1, method, dtype))
    got = res.factors.collect()
    assert len(got) == len(first) == 4 * (res.grid.x_dim + res.grid.y_dim)
    changed = {(g.side, g.id) for g in got if not np.array_equal(np.array(g.factors), first[g.side, g.id])}
    assert changed == {("W", i) for i in (0, 63, 64, 3999)} | {("H", j) for j in (5, 128, 3000)}
    again = resume(spark, path).factors
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


@pytest.mark.parametrize("schedule, written", [("diagonal", 2), ("row_major", 4)])
def test_blocks_without_ratings_are_left_alone(spark, scratch, schedule, written):
    """Ratings in the blocks (0, 0) and (2, 2) of 4 x 4: steps without any write nothing, others their blocks only."""
    r = spark.createDataFrame([(i, j, 3.0) for b in (0, 2) for i in (4 * b, 4 * b + 1) for j in (4 * b, 4 * b + 3)] , "x_id long, y_id long, rating double")
    path = scratch + "/run"
    res = fit(r, K, blocks=4, epochs=2, init=init_factors(spark, Grid(4, 15, 15, 4, 4), K), grid=Grid(4, 15, 15, 4, 4), schedule=schedule,
              path=path, keep_steps=True, eval_every=1)
    tables = [n for n in list_names(spark, path) if n.startswith("factors-") and n != "factors-00000000"]
    assert len(tables) == written
    blocks = {(s.side, s.block) for t in tables for s in spark.read.parquet(f"{path}/{t}").select("side", "block").distinct().collect()}
    assert blocks == {(s, b) for s in "WH" for b in (0, 2)}
    assert res.factors.count() == 32 and res.errors.count() == 4


def test_a_block_is_held_once_and_handed_over_in_small_batches(spark, slice_ratings):
    from latentgrid.operators.kernel import Levels
    from latentgrid.operators.step import _Side
    from latentgrid.session import BATCH_BYTES, fixed_plan_session
    ids, vals = np.arange(10), np.arange(20.0).reshape(10, 2)
    records = [(3, ids[a:b].astype("<i8").tobytes(), vals[a:b].astype("<f8").tobytes()) for a, b in ((6, 10), (0, 2), (2, 6))]
    side = _Side(records, 2, np.dtype("<f8"), "W")
    assert not records and np.array_equal(side.ids, ids) and np.array_equal(side.vals, vals) and side.block == 3
    levels, rng, x_last, y_last = Levels(), np.random.default_rng(1), {}, {}
    for scale in (1, 1, 10**12, -7):
        x, y = rng.integers(0, 300, 500) * scale, rng.integers(0, 200, 500) * scale
        want = []
        for a, b in zip(x.tolist(), y.tolist()):
            want.append(max(x_last.get(a, 0), y_last.get(b, 0)))
            x_last[a] = y_last[b] = want[-1] + 1
        assert levels.of(x, y).tolist() == want
    assert max(len(levels._x), len(levels._y)) < 1200
    fit(slice_ratings, K, blocks=2, epochs=1).cleanup()
    assert fixed_plan_session(spark).conf.get(BATCH_BYTES, None) == "4m"


def test_one_side_is_read_without_the_other(spark, scratch):
    from latentgrid.operators.grid import compute_grid
    from latentgrid.operators.step import balanced_keys, prepare_ratings
    from latentgrid.plans.train import fit
    r = spark.createDataFrame([(i % 7, i % 5, 1.0) for i in range(40)], "x_id long, y_id long, rating double")
    laid = prepare_ratings(r, compute_grid(r, 2), "diagonal", balanced_keys(spark, 2), ["x_id", "y_id"])
    seen = laid.rated_ids()
    assert sorted(map(tuple, seen.collect())) == [("H", i) for i in range(5)] + [("W", i) for i in range(7)]
    for side, column in (("W", "a"), ("H", "b")):
        plan = seen.where(f"side = '{side}'")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and f"ReadSchema: struct<{column}:binary>" in plan
    laid.unpersist()
    factors = fit(r, 2, blocks=2, epochs=1, path=scratch).factors
    for side in "WH":
        files = factors.where(f"side = '{side}'").inputFiles()
        assert files and all(f"/s={side}/" in f for f in files)
    assert factors.columns == ["side", "id", "block", "factors"] and factors.groupBy("side").count().count() == 2


def test_train_then_evaluate_parses_the_lines_once(spark, monkeypatch):
    from conftest import SF_SMALL
    from latentgrid.plans import queries
    real, read = queries.fit, []
    monkeypatch.setattr(queries, "fit", lambda r, *a, **k: read.extend(r.inputFiles()) or real(r, *a, **k))
    n = queries.q_ratings_scan(spark, SF_SMALL).count()
    assert queries.q_train_then_evaluate(spark, SF_SMALL).first()["n"] == n
    assert read and all(f.endswith(".parquet") for f in read)


def test_values_are_made_once_and_by_several_tasks(spark):
    """The ids of a fit are few bytes: their values are made after ids are distinct, and not by one task."""
    from latentgrid.functions.init import seen_factors
    rank, seen = 30, None
    for side in "WH":
        one = spark.range(60_000).selectExpr(f"'{side}' AS side", "id % 20000 AS id")
        seen = one if seen is None else seen.unionByName(one)
    seen = seen.distinct()
    rows = seen_factors(spark, Grid(4, 19_999, 19_999, 5000, 5000, 60_000), rank, 1, "hash", "double", True, seen)
    plan = pack_factor_records(rows, rank)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and not any("md5" in line for line in plan.splitlines() if "Filter" in line)
    tasks = rows.where("factors[0] >= 0").groupBy("side", F.spark_partition_id().alias("task")).count().collect()
    assert sum(t["count"] for t in tasks) == 40_000
    assert all(sum(t.side == side for t in tasks) > 1 for side in "WH")


@pytest.mark.parametrize("row", [[1.0], [1.0, 2.0, 3.0], [1.0, None], None])
def test_packed_rows_must_have_the_rank(spark, row):
    f = spark.createDataFrame([("W", 0, 0, [1.0, 2.0]), ("W", 1, 0, row)], "side string, id long, block int, factors array<double>")
    with pytest.raises(Exception, match="a factor row does not have 2 values"):
        pack_factor_records(f, 2).count()


@pytest.mark.parametrize("ids", [[3, 1, 2, 0, 4], [7, 10**12, -5, 0, 40]])
def test_places_of_dense_and_sparse_ids(ids):
    side = step_module._Side([(0, np.array(ids, "<i8").tobytes(), np.arange(10.0).tobytes())], 2, np.dtype("<f8"), "W")
    want = np.array([ids[1], ids[4], ids[0], ids[1]])
    assert side.vals[side.places(want), 0].tolist() == [2.0, 8.0, 0.0, 2.0]
    for wrong in (min(ids) - 1, max(ids) + 1, 6):
        with pytest.raises(ValueError, match=f"W id {wrong} which has no factor row"):
            side.places(np.array([ids[0], wrong]))


@pytest.mark.parametrize("piece, tasks", [(1 << 16, 1), (50, 16)])
def test_records_keep_the_order_of_samples_that_share_an_id(spark, monkeypatch, piece, tasks):
    """Several blocks in a task, and one in each: a record's samples are of one block, by level, and follow the training order where they share an id."""
    monkeypatch.setattr(step_module, "PIECE", piece)
    rng = np.random.default_rng(4)
    rows = [(int(x), int(y), float(k), k) for k, (x, y) in enumerate(rng.integers(0, 40, (3000, 2)))]
    r = spark.createDataFrame(rows, "x_id long, y_id long, rating double, k long").repartition(5)
    monkeypatch.setattr(step_module, "ROWS", 3000 // tasks)
    prep = prepare_ratings(r, compute_grid(r, 4), "diagonal", balanced_keys(spark, 4), ["k"])
    blocks = {}
    for rec in prep.stored.orderBy("step", "wk", "seq").collect():
        x, y, k, level = (np.frombuffer(v, t) for v, t in zip((rec.a, rec.b, rec.c, rec.d), ("<i8", "<i8", "<f8", "<i4")))
        assert len(x) <= piece and np.all(np.diff(level) >= 0)
        assert {((b - a) // 10 % 4, a // 10) for a, b in zip(x // 10 * 10, y // 10 * 10)} == {(rec.step, x[0] // 10)}
        blocks.setdefault((rec.step, rec.wk), []).extend(zip(x.tolist(), y.tolist(), k.tolist()))
    assert sum(map(len, blocks.values())) == 3000 and len(blocks) == 16
    for samples in blocks.values():
        for side in (0, 1):
            for one in {s[side] for s in samples}:
                order = [s[2] for s in samples if s[side] == one]
                assert order == sorted(order)
    prep.unpersist()
