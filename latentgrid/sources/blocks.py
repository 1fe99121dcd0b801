"""Blocked rating stores."""

from __future__ import annotations

import json
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latentgrid.operators.grid import Grid, assign_blocks, check_in_grid, compute_grid, schedule
from latentgrid.session import read_text, write_bytes


#: Name of the file beside a store's strata that holds its grid.
GRID_FILE = "_grid.json"


def _by_stratum(ratings: DataFrame, grid: Grid) -> DataFrame:
    """Ranges of ids are dealt out, so that a large block is written by several tasks."""
    return (assign_blocks(ratings, grid).repartitionByRange("stratum", "xb", "yb", "x_id", "y_id")
            .sortWithinPartitions("stratum", "xb", "yb"))


def write_blocked(ratings: DataFrame, grid: Grid, path: str, mode: str = "errorifexists") -> None:
    """Ratings stored by stratum (a partition column), sorted by block inside
    the files. Reading one stratum prunes the other folders. The grid is kept beside them."""
    _by_stratum(ratings, grid).write.mode(mode).partitionBy("stratum").parquet(path)
    write_bytes(ratings.sparkSession, f"{path}/{GRID_FILE}", json.dumps(asdict(grid)).encode())


def stored_grid(spark: SparkSession, path: str) -> Grid:
    return Grid(**json.loads(read_text(spark, f"{path}/{GRID_FILE}")))


def append_blocked(ratings: DataFrame, path: str, grid: Grid | None = None) -> Grid:
    """Add ratings to a store; only the strata that they fall into get files.

    Blocks come from the stored grid, so ids must lie inside it (a larger one would move every block); ``grid``, if
    given, must have its dimensions. Both are checked before anything is written. Returns the store's grid with the
    counts and largest ids of all its ratings.
    """
    spark = ratings.sparkSession
    stored = stored_grid(spark, path)
    if grid is not None and (grid.p, grid.x_dim, grid.y_dim) != (stored.p, stored.x_dim, stored.y_dim):
        raise ValueError(f"the store has {stored.p} x {stored.p} blocks of {stored.x_dim} x {stored.y_dim} ids")
    if ratings.isEmpty():
        return stored
    found = compute_grid(ratings, stored.p)
    check_in_grid(found, stored)
    _by_stratum(ratings, stored).write.mode("append").partitionBy("stratum").parquet(path)
    now = replace(stored, n=stored.n + found.n, max_x=max(stored.max_x, found.max_x), max_y=max(stored.max_y, found.max_y),
                  min_x=min(stored.min_x, found.min_x), min_y=min(stored.min_y, found.min_y))
    write_bytes(spark, f"{path}/{GRID_FILE}", json.dumps(asdict(now)).encode())
    return now


def read_stratum(spark, path: str, i: int) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("stratum") == F.lit(i))


def _sample_text(rating_fmt) -> F.Column:
    return F.concat(F.col("x_id").cast("string"), F.lit(","), F.col("y_id").cast("string"),
                    F.lit(","), rating_fmt, F.lit(";"))


#: Samples of a packed record.
PIECE = 100_000


def pack_blocks(ratings: DataFrame, grid: Grid, order_cols: list[str] | None = None, piece: int = PIECE) -> DataFrame:
    """``x,y,r;`` per sample (in ``order_cols`` order), in row-major block order.

    A block comes in records of ``piece`` samples; ``start`` is the position of a record's first one. An
    empty block is one empty record. Positions come from a window over each block, which spills; only the
    samples of one record are gathered.
    """
    order_cols = order_cols or ["x_id", "y_id", "rating"]
    pos = F.row_number().over(Window.partitionBy("xb", "yb").orderBy(*order_cols)).cast("bigint") - 1
    b = assign_blocks(ratings, grid).withColumn("pos", pos).withColumn("start", F.col("pos") - F.col("pos") % piece)
    sample = F.struct("pos", _sample_text(F.col("rating").cast("string")).alias("_t"))
    g = b.groupBy("xb", "yb", "start").agg(F.array_sort(F.collect_list(sample)).alias("s"))
    full = schedule(ratings.sparkSession, grid.p).select("xb", "yb")
    j = full.join(g, ["xb", "yb"], "left")
    return j.select("xb", "yb", (F.col("xb") * grid.p + F.col("yb")).alias("line_no"),
                    F.coalesce("start", F.lit(0)).cast("bigint").alias("start"),
                    F.coalesce(F.array_join(F.transform("s", lambda t: t["_t"]), ""),
                               F.lit("")).alias("packed"))


def unpack_blocks(packed: DataFrame) -> DataFrame:
    """S9 reader: ``(xb, yb, start, packed)`` -> one row per sample, with its position in the block."""
    samples = F.filter(F.split("packed", ";", -1), lambda t: t != F.lit(""))
    ex = packed.select("xb", "yb", "start", F.posexplode(samples).alias("at", "t"))
    parts = F.split("t", ",", -1)
    return ex.select("xb", "yb", (F.col("start") + F.col("at")).alias("pos"),
                     F.get(parts, 0).cast("bigint").alias("x_id"),
                     F.get(parts, 1).cast("bigint").alias("y_id"),
                     F.get(parts, 2).cast("double").alias("rating"))
