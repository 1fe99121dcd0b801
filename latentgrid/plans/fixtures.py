"""Rating tables derived from the driver's tables.

``ratings``: lineitem joined to its order; x = customer, y = part, rating from
the quantity band (1..5). ``vectors``: the embeddings as ``ARRAY<DOUBLE>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rating_of_quantity(q) -> F.Column:
    return (F.lit(1) + F.floor((q - F.lit(1)) / F.lit(10))).cast("double")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(x_id, y_id, rating, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)``."""
    li = table(spark, sf_dir, "lineitem").select(*ORDER_COLS)
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(F.col("o_custkey").cast("bigint").alias("x_id"),
                    F.col("l_partkey").cast("bigint").alias("y_id"),
                    rating_of_quantity(F.col("l_quantity")).alias("rating"),
                    *ORDER_COLS)


def ratings_slice(spark: SparkSession, sf_dir: str, max_x: int = 20, max_y: int = 100) -> DataFrame:
    """Small supplier x part fixture for unit tests (not a registered query input)."""
    li = table(spark, sf_dir, "lineitem").filter(
        (F.col("l_suppkey") < max_x) & (F.col("l_partkey") < max_y))
    return li.select(F.col("l_suppkey").cast("bigint").alias("x_id"),
                     F.col("l_partkey").cast("bigint").alias("y_id"),
                     rating_of_quantity(F.col("l_quantity")).alias("rating"), *ORDER_COLS)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, v ARRAY<DOUBLE>, label)``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")
