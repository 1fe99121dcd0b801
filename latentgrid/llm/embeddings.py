"""Embedding near duplicates: int8 tile products with error bounds, exact recomputation where they are open."""

from __future__ import annotations

import math
from typing import Iterator, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import bounded_batches, smallest_labels, written
from latentgrid.llm.graph import components

#: Vectors of a block.
BLOCK = 4096
#: Bytes of vectors that a tile holds of one of its two parts, while the blocks of the other pass by.
HOLD = 1 << 26
#: Rows of a block that are multiplied with the other block at once.
STRIP = 512


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors u of the rows of ``x``, and their int8 codes q, scales s, errors |u - s q| and lengths |s q|."""
    x = x / np.abs(x).max(1, keepdims=True)
    u = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    scale = np.abs(u).max(1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    # rounded up, so that the bounds hold in floating point too
    error = np.linalg.norm(u - back, axis=1) * (1 + 1e-9) + 1e-12
    return u, q, scale, error, np.linalg.norm(back, axis=1) * (1 + 1e-9)


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, threshold: float):
    """Index pairs of rows of ``a`` and ``b`` with a cosine of at least ``threshold``, strip by strip.

    u.v differs from s t (q.r) by at most |s q| e_v + e_u |t r| + e_u e_v. Pairs whose bound excludes the threshold
    are dropped, those whose bound ensures it are taken, the others are computed in double precision.
    ``same``: the blocks are one, each pair is given once.
    """
    ua, qa, sa, ea, na = quantise(a)
    ub, qb, sb, eb, nb = (ua, qa, sa, ea, na) if same else quantise(b)
    exact = np.float32 if a.shape[1] * 127 * 127 < 2**24 else np.float64  # integers that the product holds exactly
    right = qb.astype(exact).T
    for i in range(0, len(a), STRIP):
        j = min(i + STRIP, len(a))
        product = qa[i:j].astype(exact) @ right
        slack = na[i:j].max() * eb.max() + ea[i:j].max() * (nb.max() + eb.max()) + 1e-6
        rough = (product * sb.astype(exact)) >= ((threshold - slack) / sa[i:j])[:, None]
        r, c = np.nonzero(rough)
        if same:
            r, c = r[i + r < c], c[i + r < c]
        value = sa[i + r] * sb[c] * product[r, c]
        bound = na[i + r] * eb[c] + ea[i + r] * (nb[c] + eb[c]) + 1e-12
        sure = value - bound >= threshold
        open_ = np.flatnonzero(~sure & (value + bound >= threshold))
        for k in range(0, len(open_), 1 << 16):
            o = open_[k:k + (1 << 16)]
            sure[o] = np.einsum("ij,ij->i", ua[i + r[o]], ub[c[o]]) >= threshold
        yield i + r[sure], c[sure]


def _pack(key, rows):
    """All vectors of a block in one row."""
    values = rows.column("v").combine_chunks()
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    body = values.flatten().to_numpy(zero_copy_only=False)
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                     "ids": pa.array([rows.column("id").to_numpy().astype("<i8").tobytes()]),
                     "sizes": pa.array([rows.column("n").to_numpy().astype("<i8").tobytes()]),
                     "body": pa.array([body.tobytes()])})


class _Block:
    """Vectors of a block with the sizes of their classes, and the links counted so far."""

    def __init__(self, row: dict, dim: int, kind: str):
        self.ids, self.sizes = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["sizes"], "<i8")
        self.body = np.frombuffer(row["body"], kind).reshape(-1, dim)
        self.links = np.zeros(len(self.ids))

    def counted(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.links)
        return _links(self.ids[some], pa.nulls(len(some), pa.int64()), self.links[some].astype(np.int64))

    def joined(self, other: _Block, threshold: float) -> pa.RecordBatch:
        """Count the links with ``other`` (or among its own) on both sides; returns edges that connect what is linked."""
        same = self is other
        shift = 0 if same else len(self.ids)
        ids = self.ids if same else np.concatenate([self.ids, other.ids])
        left, right, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for r, c in tile_links(self.body.astype(np.float64), other.body.astype(np.float64), same, threshold):
            self.links += np.bincount(r, other.sizes[c], len(self.ids))
            other.links += np.bincount(c, self.sizes[r], len(other.ids))
            left.append(r)
            right.append(c + shift)
            held += len(r)
            if held > 2_000_000:  # only what connects them is kept
                lab = smallest_labels(len(ids), np.concatenate(left), np.concatenate(right))
                far = np.flatnonzero(lab != np.arange(len(lab)))
                left, right, held = [far], [lab[far]], len(far)
        lab = smallest_labels(len(ids), np.concatenate(left), np.concatenate(right))
        far = np.flatnonzero(lab != np.arange(len(lab)))
        return _links(ids[far], ids[lab[far]], np.zeros(len(far), np.int64))


def _links(a, b, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])


def _tile(threshold: float, kind: str):
    def links(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, i, j = (k.as_py() for k in key)
        held: list[_Block] = []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("part", "ids", "sizes", "body")}
                block = _Block(row, dim, kind)
                if row["part"] == i:
                    held.append(block)
                if i == j or row["part"] == j:
                    for other in held:
                        yield other.joined(block, threshold)
                    if i != j:
                        yield block.counted()
        for block in held:
            yield block.counted()
    return links


def near_duplicates(df: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    block: int = BLOCK, hold: int = HOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``df``, over all pairs at ``threshold`` or more.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do vectors
    of different lengths. Equal vectors are one class with a size; classes are dealt into blocks and blocks into parts
    of up to ``hold`` bytes. Each two parts of one length meet in a tile, which holds one part, lets the other's blocks pass by, and
    hands on the numbers of links and the edges that connect what it has found, never all pairs. A vector is sent once
    to each part, of which there are as few as memory and the number of cores allow. Repeated rows count as vectors; rows with a null id are linked, but name no
    component. An empty table gives an empty result. The threshold must be above 0.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id).cast("bigint").alias("vec_id"), F.col(vector).alias("v"))
    kind = "<f4" if dict(rows.dtypes)["v"] == "array<float>" else "<f8"
    if kind == "<f8":
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    good = F.expr("coalesce(v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
                  "AND exists(v, x -> x != 0), false)")
    classes = written(rows.where(good).groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
                      .withColumn("id", F.monotonically_increasing_id()), "classes")
    n, dim = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks = max(1, math.ceil(n / block))
    most = max(1, hold // (block * (dim or 1) * np.dtype(kind).itemsize))
    # a square of parts with at least two tiles for each core
    parts = min(blocks, max(math.ceil(blocks / most), math.ceil(2 * math.sqrt(df.sparkSession.sparkContext.defaultParallelism))))
    packed = written(
        classes.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "n", "v")
        .groupBy("dim", "block").applyInArrow(_pack, "dim int, block int, ids binary, sizes binary, body binary"), "blocks")
    tiles = (packed.withColumn("part", F.pmod("block", F.lit(parts)))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
             .select("dim", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "block", "ids", "sizes", "body"))
    found = written(
        # the blocks of part i come first
        tiles.repartition("dim", "i", "j").sortWithinPartitions("dim", "i", "j", "part", "block").groupBy("dim", "i", "j")
        .applyInArrow(_tile(threshold, kind), "a bigint, b bigint, n bigint"), "links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "id")
    own = (classes.join(roots, "id", "left").join(links, "id", "left")
           .select("v", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                   F.coalesce("root", "id").alias("root")))
    named = own.groupBy("root").agg(F.min("least").alias("component_id"))
    own = own.join(named, "root").select("v", "n_links", "component_id")
    out = rows.join(own, "v", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
