"""Block grid over the rating matrix.

The matrix is cut into P x P blocks of equal id ranges: block of an id is
``id div dim`` with ``dim = (max_id + P) div P``. A stratum is a set of P blocks
sharing no row block and no column block: for the diagonal schedule stratum i
holds blocks with ``pmod(yb - xb, P) = i``; for the row-major schedule the
steps are the anti-diagonals ``xb + yb = d``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEDULES = ("diagonal", "row_major")


@dataclass(frozen=True)
class Grid:
    p: int
    max_x: int
    max_y: int
    x_dim: int
    y_dim: int
    n: int = 0
    min_x: int = 0
    min_y: int = 0
    #: First ids of the blocks after the first, where blocks aren't equal ranges.
    x_edges: tuple[int, ...] = ()
    y_edges: tuple[int, ...] = ()

    def steps(self, schedule: str) -> int:
        return self.p if schedule == "diagonal" else 2 * self.p - 1


def block_dim(max_id: int, p: int) -> int:
    return (max_id + p) // p


def edge_sql(idc: str, edges, low: int = 0) -> str:
    """SQL for the number of ``edges`` (ascending) up to an id, by halving."""
    if not edges:
        return str(low)
    mid = len(edges) // 2
    return (f"CASE WHEN {idc} < {edges[mid]} THEN {edge_sql(idc, edges[:mid], low)} "
            f"ELSE {edge_sql(idc, edges[mid + 1:], low + mid + 1)} END")


def block_sql(idc: str, dim: int, edges=()) -> str:
    """SQL for the block of an id: equal ranges of ``dim`` ids, or the ranges between ``edges``."""
    return edge_sql(idc, edges) if edges else f"{idc} div {dim}"


def balanced_grid(ratings: DataFrame, p: int, accuracy: int = 100_000) -> Grid:
    """P3 with edges that give the row blocks, and the column blocks, about equal numbers of ratings.

    The edges are the ids at the P-quantiles of each side, from mergeable summaries (``approx_percentile``,
    off by at most 1/``accuracy`` of the ratings) in one pass. An id with more ratings than a block's share keeps
    its block to itself, and blocks next to it may be empty; no rating is moved away from its id.
    """
    found = compute_grid(ratings, p)
    if p == 1:
        return found
    at = F.array(*[F.lit(k / p) for k in range(1, p)])
    xs, ys = ratings.agg(F.approx_percentile("x_id", at, accuracy), F.approx_percentile("y_id", at, accuracy)).first()

    def edges(ids) -> tuple[int, ...]:
        # a block ends with its quantile; ids that hold several quantiles leave empty blocks behind
        return tuple(int(i) + 1 for i in ids)

    return replace(found, x_edges=edges(xs), y_edges=edges(ys))


def faults(x: Column, y: Column, rating: Column | None = None, grid: Grid | None = None) -> dict[str, Column]:
    """P10: what makes a rating unfit for training, by name; a rating may have several faults. Never null."""
    nothing = F.lit(False)
    found = {"null_id": x.isNull() | y.isNull(),
             "null_rating": nothing if rating is None else rating.isNull() | F.isnan(rating.cast("double")),
             "negative_id": F.coalesce(x < 0, nothing) | F.coalesce(y < 0, nothing)}
    if grid is not None:
        found["outside_grid"] = (F.coalesce(x >= grid.p * grid.x_dim, nothing) | F.coalesce(y >= grid.p * grid.y_dim, nothing))
    return found


def rating_faults(ratings: DataFrame, grid: Grid | None = None) -> DataFrame:
    """P10 as a report: ``(fault, n, clean)`` per kind of fault, with the number of ratings that have none.

    One pass with partial sums. An empty table gives zeros. Nothing is raised or dropped.
    """
    bad = faults(F.col("x_id"), F.col("y_id"), F.col("rating"), grid)
    none = ~next(iter(bad.values()))
    for c in list(bad.values())[1:]:
        none &= ~c
    one = ratings.agg(*(F.count_if(c).alias(name) for name, c in bad.items()), F.count_if(none).alias("clean"))
    return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("fault"), F.col(name).alias("n")) for name in bad])).alias("f"),
                      "clean").select("f.fault", "f.n", "clean")


def compute_grid(ratings: DataFrame, p: int, x_col: str = "x_id", y_col: str = "y_id",
                 validate: bool = True) -> Grid:
    """One aggregate job (max, min, counts fused); only a few scalars reach the driver.

    Null ids, and null or NaN ratings where there is a column ``rating``, raise: they
    would be left out of training or spread through the factors.
    """
    if p < 1:
        raise ValueError("block count P must be >= 1")
    x, y = F.col(x_col), F.col(y_col)
    bad = faults(x, y, F.col("rating") if "rating" in ratings.columns else None)
    row = ratings.agg(F.max(x).alias("mx"), F.max(y).alias("my"),
                      F.min(x).alias("nx"), F.min(y).alias("ny"),
                      F.count_if(bad["null_id"]).alias("no_id"),
                      F.count_if(bad["null_rating"]).alias("no_rating"),
                      F.count(F.lit(1)).alias("n")).first()
    n = int(row["n"])
    if validate:
        if row["no_id"]:
            raise ValueError(f"{row['no_id']} ratings have a null id")
        if row["no_rating"]:
            raise ValueError(f"{row['no_rating']} ratings are null or NaN")
        if n == 0:
            raise ValueError("no ratings")
        if row["nx"] < 0 or row["ny"] < 0:
            raise ValueError("ids must be >= 0")
    if n == 0:
        return Grid(p, -1, -1, 1, 1, 0, 0, 0)
    mx, my = int(row["mx"]), int(row["my"])
    return Grid(p, mx, my, block_dim(mx, p), block_dim(my, p), n, int(row["nx"]), int(row["ny"]))


def check_in_grid(found: Grid, grid: Grid) -> None:
    """Ratings whose grid is ``found`` must lie inside ``grid``: no step visits a block outside it."""
    if found.max_x >= grid.p * grid.x_dim or found.max_y >= grid.p * grid.y_dim:
        raise ValueError(f"ids up to ({found.max_x}, {found.max_y}) are outside the grid of "
                         f"{grid.p * grid.x_dim} x {grid.p * grid.y_dim}")


def grid_frame(ratings: DataFrame, p: int, x_col: str = "x_id", y_col: str = "y_id") -> DataFrame:
    """The grid as a one-row DataFrame, fully lazy (the ``grid_dims`` query)."""
    pl = F.lit(p).cast("bigint")
    return (ratings.agg(F.max(x_col).alias("max_x"), F.max(y_col).alias("max_y"))
            .select(pl.alias("p"), "max_x", "max_y",
                    F.expr(f"(max_x + {p}) div {p}").alias("x_dim"),
                    F.expr(f"(max_y + {p}) div {p}").alias("y_dim")))


def xb_col(grid: Grid, x: str = "x_id") -> Column:
    return F.expr(f"cast({block_sql(x, grid.x_dim, grid.x_edges)} as int)")


def yb_col(grid: Grid, y: str = "y_id") -> Column:
    return F.expr(f"cast({block_sql(y, grid.y_dim, grid.y_edges)} as int)")


def stratum_col(p: int, xb: str = "xb", yb: str = "yb") -> Column:
    return F.expr(f"cast(pmod({yb} - {xb}, {p}) as int)")


def step_col(p: int, schedule: str, xb: str = "xb", yb: str = "yb") -> Column:
    if schedule == "diagonal":
        return stratum_col(p, xb, yb)
    if schedule == "row_major":
        return (F.col(xb) + F.col(yb)).cast("int")
    raise ValueError(f"unknown schedule {schedule!r}")


def assign_blocks(ratings: DataFrame, grid: Grid, x: str = "x_id", y: str = "y_id") -> DataFrame:
    """Add ``xb``, ``yb`` and the diagonal ``stratum``."""
    return (ratings.withColumn("xb", xb_col(grid, x)).withColumn("yb", yb_col(grid, y))
            .withColumn("stratum", stratum_col(grid.p)))


def with_offset(ratings: DataFrame, grid: Grid, x: str = "x_id", y: str = "y_id") -> DataFrame:
    """Position of the id inside its block."""
    return (ratings.withColumn("x_off", F.expr(f"cast({x} % {grid.x_dim} as int)"))
            .withColumn("y_off", F.expr(f"cast({y} % {grid.y_dim} as int)")))


def stratum(blocked: DataFrame, i: int) -> DataFrame:
    """P5: ratings of stratum i (expects ``assign_blocks`` output)."""
    return blocked.filter(F.col("stratum") == F.lit(i))


def factor_work_key(p: int, i: int | str, side: str = "side", block: str = "block") -> Column:
    """W stays on its block; H block b goes to ``pmod(b - i, P)`` in stratum i (a number or a column's name)."""
    return F.expr(work_key_sql(p, i, side, block))


def work_key_sql(p: int, i: int | str, side: str = "side", block: str = "block") -> str:
    """The P7 key as SQL, which the training step uses."""
    return f"CASE WHEN {side} = 'W' THEN {block} ELSE CAST(pmod({block} - {i}, {p}) AS INT) END"


def inverse_work_key(p: int, i: int | str, key: str = "work") -> Column:
    """Inverse of the H rotation."""
    return F.expr(f"cast(pmod({key} + {i}, {p}) as int)")


def schedule(spark: SparkSession, p: int, kind: str = "diagonal") -> DataFrame:
    """``(step, xb, yb)`` for every block of the grid."""
    g = spark.range(p * p).select(F.expr(f"cast(id div {p} as int)").alias("xb"),
                                  F.expr(f"cast(id % {p} as int)").alias("yb"))
    return g.select(step_col(p, kind).alias("step"), "xb", "yb")


def block_counts(ratings: DataFrame, grid: Grid, x: str = "x_id", y: str = "y_id") -> DataFrame:
    """Rating count of every block, zero for empty blocks (P*P rows)."""
    spark = ratings.sparkSession
    counts = (ratings.select(xb_col(grid, x).alias("xb"), yb_col(grid, y).alias("yb"))
              .groupBy("xb", "yb").agg(F.count(F.lit(1)).alias("n")))
    full = schedule(spark, grid.p, "diagonal").select("xb", "yb")
    return (full.join(counts, ["xb", "yb"], "left")
            .select("xb", "yb", stratum_col(grid.p).alias("stratum"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))
