"""Rating sources.

Lines are split on a separator; tokens 0, 1, 2 are read as integer, integer,
number; further tokens are ignored. ``mode``:

* ``strict``     -- a malformed line fails the job (raised while the data is read)
* ``drop``       -- malformed lines are skipped
* ``quarantine`` -- returns ``(good, bad)``; ``bad`` keeps the raw line and a reason
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("strict", "drop", "quarantine")
_INT = r"^\s*[+-]?[0-9]+\s*$"


def _java_regex_quote(sep: str) -> str:
    """The separator as a pattern; Java splits at a single character without compiling a pattern for each line."""
    if len(sep) == 1:
        return "\\" + sep if sep in r".$|()[{^?*+\\" else sep
    return "\\Q" + sep + "\\E"


def _once(expr: Column) -> Column:
    """``expr`` worked out once a row: filters and projections on its result are not pushed below it, where they would repeat it."""
    return F.explode(F.array(expr))


def parse_rating_lines(lines: DataFrame, sep: str = ",", mode: str = "strict",
                       line_col: str = "value") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Parse a DataFrame of text lines into ``(x_id, y_id, rating)``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    toks = F.split(F.col(line_col), _java_regex_quote(sep), -1)
    cells = lines.select(F.col(line_col).alias("line"), _once(toks).alias("toks"))
    toks = F.col("toks")
    return _parse_fields(cells, F.col("line"), [F.get(toks, i) for i in range(3)], F.size(toks) < 3, mode)


def _parse_fields(df: DataFrame, line: Column, fields: list[Column], short: Column, mode: str):
    """``(x_id, y_id, rating)`` of three text columns; ``line`` is what is reported of a malformed row."""
    t0, t1, t2 = fields
    x = F.when(t0.rlike(_INT), F.trim(t0).try_cast("bigint"))
    y = F.when(t1.rlike(_INT), F.trim(t1).try_cast("bigint"))
    r = F.trim(t2).try_cast("double")
    read = F.struct(x.alias("x"), y.alias("y"), r.alias("r"), short.alias("short"))
    x, y, r = (F.col(f"read.{c}") for c in "xyr")
    reason = (F.when(F.col("read.short"), F.lit("fewer than three fields"))
              .when(x.isNull(), F.lit("bad row id"))
              .when(y.isNull(), F.lit("bad column id"))
              .when(r.isNull(), F.lit("bad rating")))
    parsed = df.select(line.alias("line"), _once(read).alias("read")).select(
        "line", x.alias("x_id"), y.alias("y_id"), r.alias("rating"), reason.alias("reason"))
    if mode == "strict":
        # a filter, not a projection: column pruning cannot drop the check
        check = F.when(F.col("reason").isNotNull(), F.raise_error(F.concat(
            F.lit("malformed rating line ("), F.col("reason"), F.lit("): "), F.col("line"))))
        return parsed.filter(check.otherwise(F.lit(True))).select("x_id", "y_id", "rating")
    good = parsed.filter(F.col("reason").isNull()).select("x_id", "y_id", "rating")
    if mode == "drop":
        return good
    bad = parsed.filter(F.col("reason").isNotNull()).select("line", "reason")
    return good, bad


def read_ratings(spark: SparkSession, path: str, sep: str = ",", mode: str = "strict",
                 header: bool = False, splits: int | None = None):
    """Read rating text files (paths and globs as Hadoop accepts them).

    ``splits``: least number of tasks that parse the lines; a file with fewer splits is dealt out line by line.

    ``sep="::"`` reads the ``a::b::c::ts`` files directly. ``header=True`` reads the
    columns of CSV files with a header line; a quoted separator stays inside its cell.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if header:
        raw = (spark.read.option("header", True).option("sep", sep)
               .option("mode", "PERMISSIVE").csv(path))
        raw = _least_splits(raw, splits)
        cells = [F.col(f"`{c}`") for c in raw.columns[:3]]
        line = F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in cells])
        fields = cells + [F.lit(None).cast("string")] * (3 - len(cells))
        return _parse_fields(raw, line, fields, F.lit(len(cells) < 3), mode)
    return parse_rating_lines(_least_splits(spark.read.text(path), splits), sep, mode)


def _least_splits(lines: DataFrame, splits: int | None) -> DataFrame:
    if splits is None or lines.rdd.getNumPartitions() >= splits:
        return lines
    return lines.repartition(splits)


def rating_lines(ratings: DataFrame, sep: str = ",", extra: list | None = None) -> DataFrame:
    """Ratings written back as text lines (``x<sep>y<sep>rating[<sep>extra]``)."""
    parts = [F.col("x_id").cast("string"), F.col("y_id").cast("string"),
             F.col("rating").cast("string")] + [F.col(c).cast("string") for c in (extra or [])]
    return ratings.select(F.concat_ws(sep, *parts).alias("value"))


def prefix_sample(df: DataFrame, n: int, order_cols: list[str], scratch: str,
                  partitions: int | None = None) -> DataFrame:
    """The first ``n`` rows in ``order_cols`` order, without passing the prefix through one task.

    Range-partition and sort by the order, write with a (partition, position)
    tag, count rows per partition (one row per partition reaches the driver),
    then keep rows whose global position is below ``n``.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(parts, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged.write.mode("errorifexists").parquet(scratch)
    t = spark.read.parquet(scratch).withColumn("_part", F.shiftright(F.col("_mid"), 33))
    counts = sorted((int(r["_part"]), int(r["c"])) for r in
                    t.groupBy("_part").agg(F.count(F.lit(1)).alias("c")).collect())
    offset, start = 0, {}
    for p, c in counts:
        start[p] = offset
        offset += c
    starts = spark.createDataFrame(list(start.items()), "_part long, _start long")
    pos = F.col("_start") + (F.col("_mid") - F.shiftleft(F.col("_part"), 33))
    out = t.join(starts, "_part").filter(pos < F.lit(n))
    return out.drop("_part", "_start", "_mid")
