"""Prediction and error.

``predict`` looks up ``w[x]`` and ``h[y]`` for every rating with two equi-joins.
A factor side is broadcast only when its size is known and under the limit
(rows x rank x 8 bytes); otherwise the joins shuffle and AQE may still pick a
broadcast from runtime sizes or split a skewed key. Where ratings may lack factors and a join
shuffles, those that do are told apart before it by a bit for each id, and take no part in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from latentgrid.functions.vectors import dot
from latentgrid.operators.grid import Grid, stratum_col, xb_col, yb_col
from latentgrid.session import scratch_path

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
MISSING_POLICIES = ("error", "drop", "nan")
#: Bytes of a broadcast number of 64 ids with its key.
BITS_BYTES = 16


def _side(factors: DataFrame, side: str, id_name: str, vec_name: str) -> DataFrame:
    return factors.filter(F.col("side") == side).select(
        F.col("id").alias(id_name), F.col("factors").alias(vec_name))


def _small(rows: int | None, rank: int | None, limit: int) -> bool:
    return rows is not None and rank is not None and rows * rank * 8 <= limit


def _maybe_broadcast(df: DataFrame, rows: int | None, rank: int | None, limit: int) -> DataFrame:
    return F.broadcast(df) if _small(rows, rank, limit) else df


def _side_rows(grid: Grid | None) -> tuple[int | None, int | None]:
    return (None, None) if grid is None else (grid.p * grid.x_dim, grid.p * grid.y_dim)


def factor_sides(factors: DataFrame, x: str = "x_id", y: str = "y_id", w: str = "w", h: str = "h", grid: Grid | None = None,
                 rank: int | None = None, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(x, w)`` and ``(y, h)`` to be joined with ratings; a side known by ``grid`` and ``rank`` to be under the limit is broadcast."""
    rows = _side_rows(grid)
    return (_maybe_broadcast(_side(factors, "W", x, w), rows[0], rank, broadcast_bytes),
            _maybe_broadcast(_side(factors, "H", y, h), rows[1], rank, broadcast_bytes))


def predict(ratings: DataFrame, factors: DataFrame, on_missing: str = "error",
            x: str = "x_id", y: str = "y_id", grid: Grid | None = None,
            rank: int | None = None, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Ratings with ``prediction = w[x] . h[y]``.

    ``on_missing``: ``error`` fails the job when an id has no factor row (checked
    inside the same pass, no extra job), ``drop`` keeps matched ratings only,
    ``nan`` keeps every rating and predicts NaN.

    With ``drop`` or ``nan``, if a side isn't known to be small enough to be broadcast, the ids that have factors are
    first gathered as bits (a job over the factors' ids), and only ratings that have both are joined with the factors.
    ``nan`` then reads the ratings twice, once for either kind: they must come out the same each time.
    """
    if on_missing not in MISSING_POLICIES:
        raise ValueError(f"on_missing must be one of {MISSING_POLICIES}")
    w, h = factor_sides(factors, x, y, "_w", "_h", grid, rank, broadcast_bytes)
    lacking = None
    if on_missing != "error" and not all(_small(n, rank, broadcast_bytes) for n in _side_rows(grid)):
        bits = _known_bits(ratings, factors, x, y, broadcast_bytes, once=on_missing == "nan")
        if bits is not None:
            if on_missing == "nan":
                lacking = _by_known(ratings, bits, x, y, both=False).withColumn("prediction", F.lit(float("nan")))
            ratings = _by_known(ratings, bits, x, y, both=True)
    how = "inner" if on_missing == "drop" else "left"
    j = ratings.join(w, x, how).join(h, y, how)
    p = dot("_w", "_h", k=rank)
    if on_missing == "error":
        # a filter, not a projection: column pruning cannot drop the check
        missing = F.col("_w").isNull() | F.col("_h").isNull()
        j = j.filter(F.when(missing, F.raise_error(F.concat(
            F.lit("no factor row for rating ("), F.col(x).cast("string"), F.lit(","),
            F.col(y).cast("string"), F.lit(")")))).otherwise(F.lit(True)))
    elif on_missing == "nan":
        p = F.coalesce(p, F.lit(float("nan")))
    cols = [c for c in ratings.columns]
    out = j.select(*cols, p.alias("prediction"))
    return out if lacking is None else out.unionByName(lacking)


def _known_bits(ratings: DataFrame, factors: DataFrame, x: str, y: str, limit: int, once: bool) -> DataFrame | None:
    """``_id_bits`` of the ids that have factors; None where ids aren't whole numbers or the bits are over ``limit`` bytes.

    ``once``: None, too, where an id has several factor rows, each of which is joined with its ratings.
    """
    types = [ratings.schema[x].dataType, ratings.schema[y].dataType, factors.schema["id"].dataType]
    if not all(isinstance(t, (ByteType, ShortType, IntegerType, LongType)) for t in types):
        return None
    path = scratch_path(factors.sparkSession, "known-ids")
    ids = factors.select("side", F.col("id").cast("bigint").alias("id")).where("id IS NOT NULL")
    _id_bits(ids, "known", F.count("*").alias("rows")).write.parquet(path)
    bits = factors.sparkSession.read.schema("side string, bucket bigint, known bigint, rows bigint").parquet(path)
    n, repeated = bits.agg(F.count("*"), F.expr("count_if(rows > bit_count(known))")).first()
    return None if n * BITS_BYTES > limit or (once and repeated) else bits


def _by_known(ratings: DataFrame, bits: DataFrame, x: str, y: str, both: bool) -> DataFrame:
    """The ratings of which both ids are in ``bits``, or the others. Null ids are in none."""
    out, known = ratings, F.lit(True)
    for side, c in (("W", x), ("H", y)):
        own = F.broadcast(bits.where(F.col("side") == side).select(F.col("bucket").alias(f"_b{side}"), F.col("known").alias(f"_k{side}")))
        out = out.join(own, F.shiftright(F.col(c).cast("bigint"), 6) == F.col(f"_b{side}"), "left")
        known &= F.coalesce(F.expr(f"getbit(_k{side}, cast(`{c}` & 63 AS int)) = 1"), F.lit(False))
    return out.where(known if both else ~known).select(*ratings.columns)


def _id_bits(ids: DataFrame, name: str, *more: F.Column) -> DataFrame:
    """``(side, bucket, <name>)``: a bit for each id of ``ids(side, id)``, 64 to a number, and ``more`` aggregates.

    Numbers are combined in a hash table of each task; bitmaps of more ids are binary values, for which Spark would sort all rows.
    """
    return ids.groupBy("side", F.shiftright("id", 6).alias("bucket")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(id & 63 AS int))")).alias(name), *more)


def missing_id_set(ratings: DataFrame, factors: DataFrame, x: str = "x_id", y: str = "y_id") -> DataFrame:
    """``(side, id)``: ids that occur in the ratings and have no factor row.

    Rated and known ids are gathered as bits, pre-aggregated in each task, and compared number by number: the
    ratings are read once, at most a row per id is shuffled and nothing is joined with the ratings. Null ids don't count.
    """
    sides = F.array(*(F.struct(F.lit(side).alias("side"), F.col(c).cast("bigint").alias("id")) for side, c in (("W", x), ("H", y))))
    rated = ratings.select(F.explode(sides).alias("s")).select("s.side", "s.id").where("id IS NOT NULL")
    known = factors.select("side", F.col("id").cast("bigint").alias("id"))
    both = _id_bits(rated, "rated").join(_id_bits(known, "known"), ["side", "bucket"], "left")
    lacking = both.select("side", "bucket", F.expr("rated & ~coalesce(known, 0L)").alias("bits")).where("bits <> 0")
    return (lacking.select("side", "bucket", "bits", F.explode(F.expr("sequence(0, 63)")).alias("bit")).where("getbit(bits, bit) = 1")
            .select("side", (F.shiftleft("bucket", 6) + F.col("bit")).cast("bigint").alias("id")))


def require_factors(ratings: DataFrame, factors: DataFrame) -> None:
    """Raise, before any join, if a rated id has no factor row; names how many and the smallest of each side."""
    lacking = missing_id_set(ratings, factors).groupBy("side").agg(F.count("*").alias("n"), F.min("id").alias("least")).collect()
    if lacking:
        raise ValueError("no factor row for " + ", ".join(f"{r['n']} {r['side']} ids (from {r['least']})" for r in lacking))


def _rated(ratings: DataFrame) -> DataFrame:
    """The three columns; a null rating, which a sum would leave out, fails the job."""
    return ratings.select("x_id", "y_id", "rating").filter(
        F.when(F.col("rating").isNull(), F.raise_error(F.lit("null rating")).cast("boolean"))
        .otherwise(F.lit(True)))


def _sse() -> F.Column:
    d = F.col("rating") - F.col("prediction")
    return F.sum(d * d)


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c not in ("squared_error", "n")],
        F.coalesce(F.col("squared_error"), F.lit(0.0)).alias("squared_error"),
        F.col("n").cast("bigint").alias("n"),
        F.when(F.col("n") > 0, F.sqrt(F.col("squared_error") / F.col("n"))).alias("rmse"))


def evaluate(ratings: DataFrame, factors: DataFrame, on_missing: str = "error",
             grid: Grid | None = None, rank: int | None = None,
             broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """A3: one row ``(squared_error, n, rmse)``; ``n = 0`` gives rmse NULL."""
    p = predict(_rated(ratings), factors, on_missing,
                grid=grid, rank=rank, broadcast_bytes=broadcast_bytes)
    agg = p.agg(_sse().alias("squared_error"), F.count(F.lit(1)).alias("n"))
    return _finish(agg)


def evaluate_blocks(ratings: DataFrame, factors: DataFrame, grid: Grid, totals: bool = False,
                    on_missing: str = "error", rank: int | None = None,
                    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """A4: ``(xb, yb, stratum, squared_error, n, rmse)`` per non-empty block.

    A5 (``totals=True``): rollup over ``(stratum, xb)`` -- per block row, per
    stratum subtotal and grand total, with a ``level`` label.
    """
    p = predict(_rated(ratings), factors, on_missing,
                grid=grid, rank=rank, broadcast_bytes=broadcast_bytes)
    p = p.select(xb_col(grid).alias("xb"), yb_col(grid).alias("yb"), "rating", "prediction")
    p = p.withColumn("stratum", stratum_col(grid.p))
    if not totals:
        agg = p.groupBy("xb", "yb", "stratum").agg(_sse().alias("squared_error"),
                                                   F.count(F.lit(1)).alias("n"))
        return _finish(agg)
    agg = (p.rollup("stratum", "xb")
           .agg(_sse().alias("squared_error"), F.count(F.lit(1)).alias("n"),
                F.grouping_id().alias("_g")))
    level = (F.when(F.col("_g") == 0, F.lit("block"))
             .when(F.col("_g") == 1, F.lit("stratum")).otherwise(F.lit("total")))
    return _finish(agg.select(level.alias("level"), "stratum", "xb", "squared_error", "n"))
