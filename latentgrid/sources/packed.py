"""Packed blocks as text files (S9, S10): one line per block, in line order, with an index of byte ranges.

The lines are those of the packed rating and factor formats; a block's line is a row, so P is to be chosen so that
a block stays below the 2 GB of one. The files are range-partitioned parts whose concatenation in name order is
the whole file. A small table beside them holds (line, file, offset, length), so that a block is read by opening
its range and nothing else.
"""

from __future__ import annotations

from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latentgrid.session import list_files

#: Folder of the index in that of the lines; Spark's readers skip names that begin so.
INDEX = "_index"


def block_lines(packed: DataFrame) -> DataFrame:
    """``(line_no, packed)``: the records of each block put together, from the output of ``pack_blocks``."""
    return packed.groupBy("line_no").agg(F.array_sort(F.collect_list(F.struct("start", "packed"))).alias("records")).select(
        F.col("line_no").cast("bigint").alias("line_no"), F.array_join("records.packed", "").alias("packed"))


def factor_block_lines(packed: DataFrame, side: str) -> DataFrame:
    """``(line_no, packed)`` of one side, from the output of ``pack_factors`` or ``pack_factor_pieces``; blocks without rows have no line."""
    if "start" in packed.columns:
        own = packed.where(F.col("side") == side).select(F.col("block").alias("line_no"), "start", "packed")
        size = F.regexp_count("packed", F.lit(";"))
        whole = own.groupBy("line_no").agg(F.sum(size).alias("n"), F.max(F.col("start") + size).alias("end"))
        return block_lines(own).join(whole, "line_no").select("line_no", F.when(F.col("n") == F.col("end"), F.col("packed")).otherwise(
            F.raise_error(F.lit("rows are missing between the records of a block"))).alias("packed"))
    return packed.where(F.col("side") == side).select(F.col("block").cast("bigint").alias("line_no"), "packed")


def write_packed(lines: DataFrame, path: str, files: int = 1) -> None:
    """Write ``(line_no, packed)`` as text in line order, and its index. Line numbers must be 0 to n - 1."""
    spark = lines.sparkSession
    st = lines.agg(F.min("line_no"), F.max("line_no"), F.count("*"), F.countDistinct("line_no")).first()
    if st[2] and (st[0] != 0 or st[1] != st[2] - 1 or st[3] != st[2]):
        raise ValueError(f"line numbers are not 0..n-1 (min {st[0]}, max {st[1]}, {st[2]} rows)")
    (lines.repartitionByRange(files, "line_no").sortWithinPartitions("line_no").select("packed")
     .write.mode("errorifexists").text(path))
    parts = list_files(spark, path)
    if not parts:
        return
    order = spark.createDataFrame([(k, p.rsplit("/", 1)[1]) for k, p in enumerate(parts)], "part int, name string")
    read = spark.read.text(parts).select(
        F.octet_length("value").cast("bigint").alias("length"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("at"))
    # a row per block, each file's in the order of its bytes; the line feed is one more
    inside = Window.partitionBy("file").orderBy("block_start", "at")
    index = read.withColumns({"offset": F.sum(F.col("length") + 1).over(inside) - F.col("length") - 1, "row": F.row_number().over(inside)})
    sizes = index.groupBy("name").agg(F.count("*").alias("n")).join(order, "name")
    first = sizes.alias("a").join(sizes.alias("b"), F.col("b.part") < F.col("a.part"), "left").groupBy(F.col("a.name").alias("name")).agg(
        F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    (index.join(first, "name").select((F.col("before") + F.col("row") - 1).alias("line_no"), "file", "offset", "length")
     .coalesce(1).sortWithinPartitions("line_no").write.parquet(f"{path}/{INDEX}"))


def packed_index(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, file, offset, length)`` of a store's lines."""
    return spark.read.schema("line_no bigint, file string, offset bigint, length bigint").parquet(f"{path}/{INDEX}")


def _open(uri: str):
    """A local file, or one in a store that Arrow opens by its URI."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path), "rb")
    from pyarrow import fs
    store, inner = fs.FileSystem.from_uri(uri)
    return store.open_input_file(inner)


def read_packed(spark: SparkSession, path: str, lines: list[int] | None = None) -> DataFrame:
    """``(line_no, packed)`` of the given lines, or of all: each task opens the ranges of its lines."""
    index = packed_index(spark, path)
    if lines is not None:
        index = index.where(F.col("line_no").isin([int(k) for k in lines]))

    def fetch(batches):
        for batch in batches:
            for line, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(file) as f:
                    f.seek(offset)
                    body = f.read(length)
                if len(body) != length:
                    raise ValueError(f"line {line} is cut short in {file}")
                yield pa.RecordBatch.from_arrays([pa.array([line]), pa.array([body.decode()], pa.string())], ["line_no", "packed"])

    if lines is None or len(lines) > 1:
        index = index.repartition("line_no")
    return index.select("line_no", "file", "offset", "length").mapInArrow(fetch, "line_no bigint, packed string")
