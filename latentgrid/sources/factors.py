"""Factor sources and sinks.

Text form (the reference format): one line per id, the K values joined by
``,``; the line number (0-based) is the id. Written as range-partitioned part
files whose concatenation in name order is the file. Native form: Parquet
``(side, id, block, factors)``, partitioned by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latentgrid.functions.vectors import join_fixed, join_text, parse_nonempty_numbers, parse_numbers
from latentgrid.session import list_files, path_exists, scratch_path

ROWS_PER_TEXT_FILE = 1_000_000


def factor_lines(factors: DataFrame, side: str, decimals: int | None = None) -> DataFrame:
    """``(id, line)`` for one side."""
    body = join_text("factors") if decimals is None else join_fixed("factors", decimals)
    return factors.filter(F.col("side") == side).select("id", body.alias("line"))


def write_factors_text(factors: DataFrame, side: str, path: str, files: int | None = None,
                       decimals: int | None = None) -> None:
    """Text export; fails when ``path`` exists (checked before any work).

    Ids are range-partitioned into ``files`` part files, each sorted by id, so
    reading the parts in name order gives the lines in id order.
    """
    spark = factors.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(path)
    # the line number is the id: the ids must be exactly 0..n-1
    st = (factors.filter(F.col("side") == side)
          .agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"),
               F.countDistinct("id").alias("ids")).first())
    if st["n"] and (st["lo"] != 0 or st["hi"] != st["n"] - 1 or st["ids"] != st["n"]):
        raise ValueError(f"{side} ids are not 0..n-1 (min {st['lo']}, max {st['hi']}, "
                         f"{st['n']} rows, {st['ids']} ids); the text format numbers rows by line, use Parquet")
    lines = factor_lines(factors, side, decimals)
    if files is None:
        files = max(1, -(-st["n"] // ROWS_PER_TEXT_FILE))
    out = lines.repartitionByRange(files, "id").sortWithinPartitions("id")
    out.select("line").write.mode("errorifexists").text(path)


def line_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``(line, pos)``: every line of the text files under ``path`` with its
    0-based position in the concatenation of the files in name order.

    Rows of one file split are contiguous and in order inside a scan partition,
    and ``monotonically_increasing_id`` counts them; one aggregate gives the
    row count and first id of every split (one small row per split reaches the
    driver), from which each split's starting line follows. The files are
    scanned once, into a table in the scratch folder that both passes read: a second
    scan could be split in another way, and its rows would miss their offsets.
    """
    files = list_files(spark, path)
    rank = {f: i for i, f in enumerate(files)}
    lines = (spark.read.text(files)
             .select(F.col("value").alias("line"),
                     F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_start"),
                     F.monotonically_increasing_id().alias("_mid")))
    scanned = scratch_path(spark, "factor-lines")
    lines.write.parquet(scanned)
    lines = spark.read.schema(lines.schema).parquet(scanned)
    splits = (lines.groupBy("_file", "_start")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")).collect())

    def order(r):
        f = r["_file"]
        return (rank.get(f, rank.get(f.replace("file:///", "file:/"), len(files))), f, r["_start"])

    offset, table = 0, []
    for r in sorted(splits, key=order):
        table.append((r["_file"], int(r["_start"]), offset - int(r["_first"])))
        offset += int(r["_n"])
    shift = spark.createDataFrame(table, "_file string, _start long, _shift long")
    return (lines.join(shift, ["_file", "_start"])
            .select("line", (F.col("_mid") + F.col("_shift")).alias("pos")))


def read_factors(spark: SparkSession, path: str, side: str) -> DataFrame:
    """Text import; line position (over part files in name order) is the id,
    unreadable cells become NaN."""
    lines = line_numbers(spark, path)
    return lines.select(F.lit(side).alias("side"), F.col("pos").alias("id"),
                        parse_numbers(F.col("line")).alias("factors"))


def with_blocks(factors: DataFrame, x_dim: int, y_dim: int) -> DataFrame:
    blk = F.when(F.col("side") == "W", F.expr(f"cast(id div {x_dim} as int)")).otherwise(
        F.expr(f"cast(id div {y_dim} as int)"))
    return factors.select("side", "id", blk.alias("block"), "factors")


def write_factors(factors: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Native sink, Parquet partitioned by side."""
    factors.write.mode(mode).partitionBy("side").parquet(path)


def load_factors(spark: SparkSession, path: str) -> DataFrame:
    """Native source."""
    df = spark.read.parquet(path)
    return df.select("side", "id", "block", "factors")


def _block_row(decimals: int | None) -> Column:
    """A factor row as the packed format has it: values ended by ``,``, the row by ``;``."""
    fmt = (lambda x: x.cast("string")) if decimals is None else \
        (lambda x: F.format_string(f"%.{decimals}f", x))
    return F.concat(F.array_join(F.transform("factors", lambda v: F.concat(fmt(v), F.lit(","))), ""), F.lit(";"))


def pack_factors(factors: DataFrame, decimals: int | None = None) -> DataFrame:
    """One record per (side, block): rows ended by ``;``, values ended by ``,``.

    The format holds a block of ``dim = max_id / P`` rows in one record: P is to be chosen
    so that a block fits a record. ``pack_factor_pieces`` has no such bound.
    """
    g = (factors.select("side", "block", "id", _block_row(decimals).alias("t"))
         .groupBy("side", "block")
         .agg(F.array_sort(F.collect_list(F.struct("id", "t"))).alias("rows")))
    return g.select("side", "block",
                    F.array_join(F.transform("rows", lambda s: s["t"]), "").alias("packed"))


#: Rows of a packed record.
PIECE = 16_384


def _dim(dims: dict[str, int]) -> Column:
    return F.when(F.col("side") == "W", F.lit(dims["W"])).otherwise(F.lit(dims["H"])).cast("bigint")


def pack_factor_pieces(factors: DataFrame, dims: dict[str, int], decimals: int | None = None, piece: int = PIECE) -> DataFrame:
    """S10 in records of up to ``piece`` rows: ``(side, block, start, packed)``, put together as ``pack_factors`` has a block.

    ``start`` is the position in the block of a record's first row. It follows from the id, so that no block is sorted
    or gathered. The format keeps no ids: a record's rows must be those of ids from its first one on, and a gap or a repeated id in them
    fails the job. A block's last record may be shorter, and so may others, unless they become one line of a file.
    """
    rows = factors.select("side", "block", (F.col("id") - F.col("block") * _dim(dims)).alias("pos"), _block_row(decimals).alias("t"))
    g = (rows.withColumn("start", F.col("pos") - F.pmod("pos", F.lit(piece)))
         .groupBy("side", "block", "start")
         .agg(F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("rows"), F.countDistinct("pos").alias("n"), F.max("pos").alias("last")))
    whole = (F.size("rows") == F.col("n")) & (F.col("n") == F.col("last") - F.col("start") + 1)
    text = F.when(whole, F.array_join("rows.t", "")).otherwise(F.raise_error(F.lit("factor rows of a block have a gap or a repeated id")))
    return g.select("side", "block", "start", text.alias("packed"))


def unpack_factors(packed: DataFrame, dims: dict[str, int]) -> DataFrame:
    """S10 reader: ``(side, block, packed)``, with ``start`` or without -> ``(side, id, block, factors)``;
    empty rows and empty cells are skipped, row i of block b is id ``b*dim + i``."""
    rows = F.filter(F.split("packed", ";", -1), lambda t: F.trim(t) != F.lit(""))
    start = F.col("start") if "start" in packed.columns else F.lit(0)
    ex = packed.select("side", "block", start.alias("start"), F.posexplode(rows).alias("pos", "row_txt"))
    return ex.select("side", (F.col("block").cast("bigint") * _dim(dims) + F.col("start") + F.col("pos")).alias("id"),
                     "block", parse_nonempty_numbers(F.col("row_txt")).alias("factors"))
