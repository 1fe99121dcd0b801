import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from latentgrid.functions.init import init_factors
from latentgrid.operators.evaluate import evaluate, evaluate_blocks, predict
from latentgrid.operators.grid import compute_grid
from latentgrid.plans import fixtures


@pytest.fixture(scope="module")
def model(spark):
    r = fixtures.ratings(spark, SF_SMALL).persist()
    g = compute_grid(r, 4)
    return r, g, init_factors(spark, g, 3)


def test_evaluate_matches_numpy(spark, model):
    r, g, f = model
    fac = {(x["side"], x["id"]): np.array(x["factors"]) for x in f.collect()}
    pdf = r.toPandas()
    pred = np.array([fac[("W", a)] @ fac[("H", b)] for a, b in zip(pdf.x_id, pdf.y_id)])
    sse = float(((pdf.rating.values - pred) ** 2).sum())
    e = evaluate(r, f, grid=g, rank=3).first()
    assert e["n"] == len(pdf)
    assert abs(e["squared_error"] - sse) < 1e-6 * sse
    assert abs(e["rmse"] - np.sqrt(sse / len(pdf))) < 1e-9


def test_rollup_totals(spark, model):
    r, g, f = model
    roll = evaluate_blocks(r, f, g, totals=True).collect()
    total = [x for x in roll if x["level"] == "total"][0]
    blocks = [x for x in roll if x["level"] == "block"]
    strata = [x for x in roll if x["level"] == "stratum"]
    assert sum(b["n"] for b in blocks) == total["n"] == r.count()
    assert len(strata) == 4
    assert abs(sum(s["squared_error"] for s in strata) - total["squared_error"]) < 1e-6
    plain = evaluate_blocks(r, f, g).count()
    assert plain == len(blocks)


def test_missing_policies(spark, model):
    r, g, f = model
    f2 = f.filter(~((F.col("side") == "W") & (F.col("id") < 10)))
    n_missing = r.filter("x_id < 10").count()
    assert n_missing > 0
    with pytest.raises(Exception, match="no factor row"):
        predict(r, f2, "error").count()
    assert predict(r, f2, "drop").count() == r.count() - n_missing
    nan = predict(r, f2, "nan")
    assert nan.count() == r.count()
    assert nan.filter(F.isnan("prediction")).count() == n_missing


def test_broadcast_only_when_small(spark, model):
    r, g, f = model
    small = predict(r, f, grid=g, rank=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in small.lower()
    big = predict(r, f, grid=g, rank=3, broadcast_bytes=10)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "strategy=broadcast" not in big.lower()


def test_missing_ids_from_bitmaps(spark):
    from latentgrid.operators.evaluate import missing_id_set, require_factors
    ids = [0, 1, 2, 32767, 32768, 32769, 65536, 65537, 10**12, 7]
    r = spark.createDataFrame([(i, 2 * i) for i in ids + ids] + [(None, 0)], "x_id long, y_id long")
    f = spark.createDataFrame([("W", i) for i in (0, 2, 32768, 5, 10**12)] + [("H", 2 * i) for i in ids], "side string, id long")
    got = sorted(map(tuple, missing_id_set(r, f).collect()))
    assert got == [("W", i) for i in (1, 7, 32767, 32769, 65536, 65537)]
    plan = missing_id_set(r, f)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    with pytest.raises(ValueError, match="6 W ids .from 1."):
        require_factors(r, f)
    require_factors(r.where("x_id = 2"), f)
    assert missing_id_set(r.limit(0), f).count() == 0 and missing_id_set(r, f.limit(0)).count() == 20


def test_missing_ids_are_gathered_without_sorting_the_ratings(spark):
    from latentgrid.operators.evaluate import missing_id_set
    ids = [-130, -65, -64, -1, 0, 63, 64, 2**62, -(2**63)]
    r = spark.createDataFrame([(i, i) for i in ids], "x_id long, y_id long")
    f = spark.createDataFrame([(side, i) for side in "WH" for i in ids if side == "H" or i not in (-64, 63, 2**62, -(2**63))], "side string, id long")
    found = missing_id_set(r, f)
    assert sorted(map(tuple, found.collect())) == [("W", i) for i in (-(2**63), -64, 63, 2**62)]
    # the ratings are read once, and added up in hash tables
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and plan.count("HashAggregate") == 4 and "Union" not in plan


def test_ratings_without_factors_take_no_part_in_the_joins(spark):
    ids = [None, -65, -1, 0, 63, 64, 10**12, 7, 7]
    r = spark.createDataFrame([(x, y, float(k)) for k, (x, y) in enumerate((x, y) for x in ids for y in ids)], "x_id long, y_id long, rating double")
    rows = [("W", i, [1.0, 2.0]) for i in (-65, 0, 7, 10**12)] + [("H", i, [3.0, 4.0]) for i in (-1, 0, 7, 64)]
    f = spark.createDataFrame(rows + [("W", 63, None), ("H", None, [1.0, 1.0])], "side string, id long, factors array<double>")
    twice = f.union(f.where("id = 64 or id is null"))
    for policy, f in (("drop", f), ("nan", f), ("drop", twice)):
        plain = predict(r, f, policy, broadcast_bytes=0)  # no room for the bits
        got = predict(r, f, policy, broadcast_bytes=1 << 10)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "getbit" in plan and plan.count("strategy=broadcast") == (4 if policy == "nan" else 2)
        assert "getbit" not in plain._jdf.queryExecution().optimizedPlan().toString()
    # an id with several factor rows gives as many predictions, with or without a row of the other side
    assert sorted(map(repr, predict(r, twice, "nan").collect())) == sorted(map(repr, predict(r, twice, "nan", broadcast_bytes=0).collect()))
    # ids that aren't whole numbers are joined as they are
    text = r.select(F.col("x_id").cast("string").alias("x_id"), "y_id", "rating")
    assert sorted(map(repr, predict(text, f, "drop").collect())) == sorted(map(repr, predict(text, f, "drop", broadcast_bytes=0).collect()))


def test_queries_on_partly_known_factors_join_without_a_shuffle_of_the_ratings(spark):
    from latentgrid.plans.queries import q_missing_ids, q_predictions_drop
    for q in (q_missing_ids, q_predictions_drop):
        assert q(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 2


def test_one_sample_broadcasts_factors_known_to_be_small(spark):
    from latentgrid.plans.queries import q_sgd_one_sample
    assert q_sgd_one_sample(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 2
