"""Token counts of flat token files: separator scan by blocks, stitched by a prefix scan.

A flat file is a run of little-endian unsigned ids in which an end-of-document id follows each document;
there is no index. Files are cut into blocks, byte ranges that any task can read alone. A first scan counts the
separators of each block; their prefix sum numbers the documents. A second scan finds the pieces of documents
that lie in each block, and the pieces of a document are added up.
"""

from __future__ import annotations

from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latentgrid.llm.common import flat

#: Bytes of a block, and about those of all blocks of a task.
BLOCK = 1 << 20
TASK_BYTES = 1 << 24
#: Ids in front of a document that hold its key, 15 bits each.
HEADER = 5
EOD = 0


def with_header(packed: Column, key: Column) -> Column:
    """Ids of a document (32 bits each, packed) as a flat file's 16-bit ids + 1, after a header with the key.

    Id 0 ends documents. A key is a number under 2**74 or so, in practice a non-negative bigint or null.
    """
    @F.arrow_udf("binary")
    def pack(ids: pa.Array, keys: pa.Array) -> pa.Array:
        data, at = flat(ids)
        values = data.view("<u4").astype(np.int64) + 1
        if len(values) and values.max() > 0xFFFF:
            raise ValueError("ids over 65534 don't fit")
        known = np.asarray(keys.is_valid())
        number = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        digits = np.zeros((len(number), HEADER), np.int64)
        for k in range(HEADER):
            digits[:, k] = (number >> (15 * k) & 0x7FFF) + 1
        digits[~known, 0] = 0xFFFF  # no digit
        ends = at // 4
        small = values.astype("<u2")
        head = digits.astype("<u2")
        return pa.array([head[k].tobytes() + small[ends[k]:ends[k + 1]].tobytes() for k in range(len(number))], pa.binary())

    return pack(packed, key)


def write_flat(documents: DataFrame, path: str, value: str = "value") -> None:
    """Write packed 16-bit ids, one document per row, as flat files ended by id 0 after each document."""
    documents.select(F.col(value).cast("string")).write.text(path, lineSep="\0\0")


def _opened(path: str):
    """A file of the shared storage, as Spark's readers name it, to read ranges of."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return open("/" + (rest if colon else path).lstrip("/"), "rb", buffering=0)
    from pyarrow.fs import FileSystem

    files, name = FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    return files.open_input_file(name)


def _read(path: str, begin: int, end: int) -> bytes:
    out = bytearray()
    with _opened(path) as f:
        f.seek(begin)
        while len(out) < end - begin:
            if not (some := f.read(end - begin - len(out))):
                raise ValueError(f"{path} ends before byte {end}")
            out += some
    return bytes(out)


def _separators(dtype: str, eod: int):
    wide = np.dtype(dtype).itemsize

    def scan(batches):
        for batch in batches:
            ends = []
            for path, length, begin, end in zip(*(c.to_pylist() for c in batch.columns[:4])):
                if length % wide:
                    raise ValueError(f"{path} is cut inside an id")
                ends.append(int(np.count_nonzero(np.frombuffer(_read(path, begin, end), dtype) == eod)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.int64())], names=[*batch.schema.names, "ends"])
    return scan


def _pieces(dtype: str, eod: int, header: int):
    wide = np.dtype(dtype).itemsize

    def scan(batches):
        for batch in batches:
            for path, length, begin, end, base, docs in zip(*(c.to_pylist() for c in batch.columns)):
                # the id before the block, and behind it those of a header that begins in it
                low, high = max(begin - wide, 0), min(end + header * wide, length)
                ids = np.frombuffer(_read(path, low, high), dtype)
                skip, total = (begin - low) // wide, (length - low) // wide
                own = ids[skip:skip + (end - begin) // wide]
                ends = np.flatnonzero(own == eod)
                edges = np.concatenate([[-1], ends, [len(own)]])
                # the last piece is the start of a document that the next block goes on with, or nothing
                pieces = np.diff(edges) - 1
                starts = skip + edges[:-1] + 1
                fresh = np.append(begin == 0 or ids[skip - 1] == eod, np.ones(len(ends), bool)) & (starts < total)
                keys = np.zeros(len(pieces), np.int64)
                known = fresh & (starts + header <= total) & (header > 0)
                for k in range(header):
                    digit = ids[np.minimum(starts + k, len(ids) - 1)].astype(np.int64)
                    known &= (digit > 0) & (digit <= 0x8000)
                    keys |= np.where(known, digit - 1, 0) << (15 * k)
                number = base + np.arange(len(pieces))
                for a in range(0, len(pieces), 100_000):
                    b = slice(a, a + 100_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([path] * len(pieces[b])), pa.array(number[b]), pa.array(keys[b], mask=~known[b]),
                        pa.array(pieces[b].astype(np.int64)), pa.array(number[b] < docs)],
                        names=["file", "document", "key", "ids", "closed"])
    return scan


def token_counts(spark: SparkSession, path: str, dtype: str = "<u2", eod: int = EOD, header: int = 0,
                 block: int = BLOCK) -> DataFrame:
    """``(file, document, key, n_tokens, closed)`` of each document of the flat files in ``path``.

    Documents are numbered from 0 in each file. ``closed`` is false for ids after the last separator of a file.
    ``n_tokens`` leaves out the separator and the ``header`` ids, which give ``key`` (null without or for a null
    key). Files without ids give no rows. Files of any size are read by blocks, which tasks share out; ``path`` must be
    a folder that all executors see, or in a store that pyarrow opens (hdfs, s3, gs).
    """
    wide = np.dtype(dtype).itemsize
    step = max(1, block // wide) * wide
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "length")
    n = -(-(files.agg(F.sum("length")).first()[0] or 0) // max(TASK_BYTES, step)) or 1
    begin = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(step).cast("bigint")))
    blocks = (files.select("file", "length", begin.alias("begin"))
              .withColumn("end", F.least(F.col("begin") + step, "length")))
    shape = "file string, length bigint, begin bigint, end bigint"
    counted = blocks.repartition(n, "file", "begin").mapInArrow(_separators(dtype, eod), f"{shape}, ends bigint")
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.select("file", "length", "begin", "end", F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("base"),
                              F.sum("ends").over(Window.partitionBy("file")).alias("docs"))
    pieces = numbered.repartition(n, "file", "begin").mapInArrow(
        _pieces(dtype, eod, header), "file string, document bigint, key bigint, ids bigint, closed boolean")
    return (pieces.groupBy("file", "document").agg(
                F.max("key").alias("key"), F.sum("ids").alias("ids"), F.max("closed").alias("closed"))
            .where("closed OR ids > 0")
            .select("file", "document", "key", (F.col("ids") - header).alias("n_tokens"), "closed"))
