import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from latentgrid.operators.grid import (assign_blocks, block_counts, block_dim, compute_grid,
                                       factor_work_key, inverse_work_key, rating_faults, schedule)
from latentgrid.plans import fixtures


def test_block_dim():
    assert block_dim(1499, 8) == 188
    assert block_dim(0, 4) == 1
    for p in range(1, 9):
        for m in range(0, 50):
            d = block_dim(m, p)
            assert p * d >= m + 1 and m // d < p


@pytest.mark.parametrize("p", [1, 2, 3, 5, 8])
def test_strata_cover_grid_once(spark, p):
    s = schedule(spark, p, "diagonal").collect()
    assert len(s) == p * p
    for i in range(p):
        blocks = [(r.xb, r.yb) for r in s if r.step == i]
        assert len(blocks) == p
        assert len({b[0] for b in blocks}) == p and len({b[1] for b in blocks}) == p


@pytest.mark.parametrize("p", [1, 4, 7])
def test_rotation_inverts(spark, p):
    df = spark.range(p).select(F.lit("H").alias("side"), F.col("id").cast("int").alias("block"))
    for i in range(p):
        w = df.select("block", factor_work_key(p, i).alias("work"))
        back = w.select("block", inverse_work_key(p, i, "work").alias("b2"))
        assert all(r.block == r.b2 for r in back.collect())


def test_every_rating_in_one_stratum(spark):
    r = fixtures.ratings(spark, SF_SMALL)
    g = compute_grid(r, 8)
    b = assign_blocks(r, g)
    assert b.filter((F.col("xb") >= 8) | (F.col("yb") >= 8)).count() == 0
    bc = block_counts(r, g)
    assert bc.count() == 64
    assert bc.agg(F.sum("n")).first()[0] == r.count()


def test_negative_ids_rejected(spark):
    df = spark.createDataFrame([(-1, 0, 1.0)], "x_id long, y_id long, rating double")
    with pytest.raises(ValueError, match=">= 0"):
        compute_grid(df, 2)


def test_rating_faults(spark):
    rows = [(0, 0, 1.0), (None, 1, 1.0), (2, None, None), (-1, 3, float("nan")), (1, -4, 2.0), (4, 0, 1.0), (3, 3, 1.0), (None, -1, 1.0)]
    df = spark.createDataFrame(rows, "x_id long, y_id long, rating double")
    g = compute_grid(spark.createDataFrame([(3, 3, 1.0)], df.schema), 2)
    found = {r.fault: (r.n, r.clean) for r in rating_faults(df, g).collect()}
    assert found == {"null_id": (3, 2), "null_rating": (2, 2), "negative_id": (3, 2), "outside_grid": (1, 2)}
    assert {r.fault: (r.n, r.clean) for r in rating_faults(df.limit(0)).collect()} == {
        "null_id": (0, 0), "null_rating": (0, 0), "negative_id": (0, 0)}
