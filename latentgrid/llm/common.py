"""Helpers shared by the operators: scratch tables and flat numpy views of text columns."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from latentgrid.session import bounded_batches, remove_path, scratch_path  # noqa: F401

#: Bytes of text that one numpy pass works on; a longer text is a pass of its own.
PASS_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back; a folder for each value of ``by``.

    Cuts the lineage without tying rows to an executor: a lost executor costs only the
    tasks that it ran.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=by)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made, once nothing reads them any more."""
    for df in tables:
        if path := getattr(df, "scratch", None):
            remove_path(df.sparkSession, path)


def stored(path: str, columns: list[str]) -> pa.Table:
    """In a task: columns of the parquet files in a folder of the shared storage; of a missing one no rows."""
    import pyarrow.dataset as ds
    from pyarrow.fs import FileSystem, FileType, LocalFileSystem

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        files, name = LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    else:
        files, name = FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    if files.get_file_info(name).type == FileType.NotFound:
        return pa.table({c: pa.array([], pa.int64()) for c in columns})
    return ds.dataset(name, filesystem=files, format="parquet").to_table(columns)


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string or binary array, and the n + 1 offsets of its values (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], at - at[0]


def passes(offsets: np.ndarray, limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (i, j) of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte offset of each with the total at the end."""
    cps = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    size = np.ones(len(cps), np.int64)
    for least in (0x80, 0x800, 0x10000):
        size += cps >= least
    at = np.zeros(len(cps) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    return cps, at


LETTER, NUMBER, SPACE = 1, 2, 3


@functools.cache
def char_classes() -> np.ndarray:
    """Class of each code point: LETTER, NUMBER, SPACE or 0."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = (ord(every[k]) for k in (m.start(), m.end() - 1))
            out[a:b + 1] = kind
    out[0xD800:0xE000] = 0
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[k], starts[k] + 1, ... of all k, one after another."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


_R = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    if n < PASS_BYTES:
        return _short_powers(base)[:n + 1]
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


@functools.cache
def _short_powers(base: np.uint64) -> np.ndarray:
    out = _powers(base, PASS_BYTES)
    out.flags.writeable = False
    return out


def span_hashes(chars: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``chars[a[k]:b[k]]``: a polynomial, as a difference of prefix sums. ``chars`` are above 0."""
    power = _powers(_R, len(chars))
    prefix = np.append(np.uint64(0), np.cumsum(chars * power[:-1], dtype=np.uint64))
    return mix((prefix[b] - prefix[a]) * _powers(_INV, len(chars))[a])


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges a[k] - b[k]: the smallest node of each node's component."""
    lab = np.arange(n)
    while len(a):
        low = np.minimum(lab[a], lab[b])
        new = lab.copy()
        for side in (a, b, lab[a], lab[b]):
            np.minimum.at(new, side, low)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, lab):
            break
        lab = new
        open_ = lab[a] != lab[b]
        a, b = a[open_], b[open_]
    return lab
