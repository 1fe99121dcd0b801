"""Random factor initialisation (G1).

``hash`` (default): value k of id i on side s is
``conv(substr(md5('seed:s:i:k'), 1, 13), 16, 10) / 2^52`` -- uniform in [0, 1),
independent of partitioning and equal to the same expression in other SQL
engines. ``stream``: the draws of one seeded generator in the order in which a sequential program
makes them, all rows of W by id and then all of H; every task jumps to the draws of its ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latentgrid.operators.grid import Grid, block_sql

TWO_POW_52 = float(2 ** 52)

# L'Ecuyer's combined generator of 1988, (modulus, multiplier) of its two parts.
PARTS = ((2147483563, 40014), (2147483399, 40692))
#: Up to so many values of a row are written out one by one, which Spark compiles; higher-order functions are interpreted.
UNROLLED = 8
#: Values that a task makes: at least, where there are fewer tasks than cores, and at most.
TASK_VALUES = (1 << 16, 1 << 24)
#: Bits of a draw's number.
JUMP_BITS = 61


def hash_uniform(seed, side, idc, k) -> Column:
    """Uniform [0,1) double from the md5 of ``seed:side:id:k`` (52 bits)."""
    key = F.concat_ws(":", F.lit(str(seed)), side, idc.cast("string"), k.cast("string"))
    # 52 bits: as a whole number they are read faster than as a double, and are the same
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(TWO_POW_52)


def stream_states(seed: int) -> tuple[int, int]:
    """States of the generator's two parts before the first draw: 1 to the modulus - 1."""
    return tuple(1 + (seed * 2 + k) % (m - 1) for k, (m, _) in enumerate(PARTS))


def stream_uniform(seed: int, first: Column, k: int) -> Column:
    """Draws ``first`` to ``first + k - 1`` of the stream, each in (0, 1).

    After n draws a part's state is ``state * a^n mod m``; the power is put together from the bits of n,
    so a draw costs the same wherever it is. All products stay below 2^62.
    """
    parts = []
    for state, (m, a) in zip(stream_states(seed), PARTS):
        powers = F.array(*[F.lit(pow(a, 1 << b, m)).cast("bigint") for b in range(JUMP_BITS)])
        jump = F.aggregate(
            F.sequence(F.lit(0), F.lit(JUMP_BITS - 1)), F.lit(state).cast("bigint"),
            lambda s, b: F.when(F.call_function("getbit", first, b) == 1, s * F.get(powers, b) % m).otherwise(s))
        # the state before the first of these draws, then one step for each
        parts.append(F.aggregate(
            F.sequence(F.lit(1), F.lit(k)), F.array(jump),
            lambda out, _: F.array_append(out, F.element_at(out, -1) * F.lit(a).cast("bigint") % m)))
    top = PARTS[0][0]
    return F.transform(F.slice(F.zip_with(parts[0], parts[1], lambda x, y: F.pmod(x - y, F.lit(top - 1).cast("bigint"))), 2, k),
                       lambda z: F.when(z == 0, F.lit(top - 1)).otherwise(z).cast("double") / F.lit(float(top)))


def factor_rows(spark: SparkSession, side: str, n_rows: int, dim: int, k: int,
                seed: int = 1, method: str = "hash", dtype: str = "double",
                ids: DataFrame | None = None, drawn: int = 0, edges: tuple[int, ...] = ()) -> DataFrame:
    """Factor rows ``(side, id, block, factors)`` for ids ``0..n_rows-1``, or for
    the ids of the one-column DataFrame ``ids``. ``drawn``: rows that the stream has drawn before id 0."""
    ids = spark.range(n_rows) if ids is None else ids.select(F.col(ids.columns[0]).alias("id"))
    s = F.lit(side)
    if method == "hash" and k <= UNROLLED:
        vec = F.array(*[hash_uniform(seed, s, F.col("id"), F.lit(kk)) for kk in range(k)])
    elif method == "hash":
        vec = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                          lambda kk: hash_uniform(seed, s, F.col("id"), kk))
    elif method == "stream":
        vec = stream_uniform(seed, (F.col("id") + F.lit(drawn).cast("bigint")) * F.lit(k).cast("bigint"), k)
    else:
        raise ValueError(f"unknown init method {method!r}")
    out = ids.select(s.alias("side"), F.col("id"),
                     F.expr(f"cast({block_sql('id', dim, edges)} as int)").alias("block"),
                     vec.alias("factors"))
    if dtype == "float":
        out = out.withColumn("factors", F.col("factors").cast("array<float>"))
    return out


def init_tasks(spark: SparkSession, rows: int, k: int) -> int:
    """Tasks that make ``rows`` rows of ``k`` values. Their ids are few bytes, by which Spark would put all into a few tasks."""
    few, many = (-(-rows * k // n) for n in TASK_VALUES)
    return max(1, min(few, max(many, 2 * spark.sparkContext.defaultParallelism)))


def init_factors(spark: SparkSession, grid: Grid, k: int, seed: int = 1,
                 method: str = "hash", dtype: str = "double", pad: bool = True,
                 ratings: DataFrame | None = None) -> DataFrame:
    """W and H for a grid: ``P * dim`` rows each (``pad=False``: ids up to the max only).

    With ``ratings`` given, rows are made only for the ids that occur there
    (for sparse id spaces); their values are the same as in the dense tables.
    """
    if k < 1:
        raise ValueError("rank must be >= 1")
    nx = grid.p * grid.x_dim if pad else grid.max_x + 1
    ny = grid.p * grid.y_dim if pad else grid.max_y + 1
    if ratings is not None:
        wx = ratings.select(F.col("x_id").cast("bigint")).distinct()
        hy = ratings.select(F.col("y_id").cast("bigint")).distinct()
        return (factor_rows(spark, "W", 0, grid.x_dim, k, seed, method, dtype, ids=wx, edges=grid.x_edges)
                .unionByName(factor_rows(spark, "H", 0, grid.y_dim, k, seed, method, dtype, ids=hy, drawn=nx, edges=grid.y_edges)))
    w = factor_rows(spark, "W", nx, grid.x_dim, k, seed, method, dtype, edges=grid.x_edges)
    h = factor_rows(spark, "H", ny, grid.y_dim, k, seed, method, dtype, drawn=nx, edges=grid.y_edges)
    return w.unionByName(h)


def seen_factors(spark: SparkSession, grid: Grid, k: int, seed: int, method: str, dtype: str, pad: bool, seen: DataFrame) -> DataFrame:
    """The rows of ``init_factors`` whose ids are in ``seen(side, id)``, which has each once."""
    nx = grid.p * grid.x_dim if pad else grid.max_x + 1
    ny = grid.p * grid.y_dim if pad else grid.max_y + 1
    w, h = (seen.where(F.col("side") == side).select("id").repartition(init_tasks(spark, min(n, grid.n or n), k), "id") for side, n in (("W", nx), ("H", ny)))
    return (factor_rows(spark, "W", 0, grid.x_dim, k, seed, method, dtype, ids=w, edges=grid.x_edges)
            .unionByName(factor_rows(spark, "H", 0, grid.y_dim, k, seed, method, dtype, ids=h, drawn=nx, edges=grid.y_edges)))


def unseen_factors(spark: SparkSession, grid: Grid, k: int, seed: int, method: str, dtype: str, pad: bool, seen: DataFrame) -> DataFrame:
    """The rows of ``init_factors`` whose ids aren't in ``seen(side, id)``.

    Ids are told apart 64 at a time, by a number with a bit for each: what is shuffled is a row for 64 ids of the grid.
    """
    nx = grid.p * grid.x_dim if pad else grid.max_x + 1
    ny = grid.p * grid.y_dim if pad else grid.max_y + 1
    out = []
    for side, n, dim, edges, drawn in (("W", nx, grid.x_dim, grid.x_edges, 0), ("H", ny, grid.y_dim, grid.y_edges, nx)):
        bits = (seen.where(F.col("side") == side).groupBy(F.shiftright("id", 6).alias("bucket"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(id & 63 AS int))")).alias("bits")))
        every = spark.range((n + 63) // 64).withColumnRenamed("id", "bucket").repartition(init_tasks(spark, n, k), "bucket").join(bits, "bucket", "left")
        bit = F.explode(F.expr("filter(sequence(0, 63), b -> bits IS NULL OR getbit(bits, b) = 0)")).alias("bit")
        ids = every.select("bucket", bit).select((F.shiftleft("bucket", 6) + F.col("bit")).alias("id")).where(F.col("id") < n)
        out.append(factor_rows(spark, side, 0, dim, k, seed, method, dtype, ids=ids, drawn=drawn, edges=edges))
    return out[0].unionByName(out[1])
